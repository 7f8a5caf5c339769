SELECT * FROM o_messages WHERE __op = 'c' AND source = 'live' AND employee_id IS NOT NULL
