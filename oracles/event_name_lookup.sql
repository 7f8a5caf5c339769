WITH live AS (
    SELECT * FROM o_messages WHERE __op = 'c' AND source = 'live' AND employee_id IS NOT NULL
), named AS (
    SELECT l.*, coalesce(k.first_name || ' ' || k.last_name, 'Employé #' || l.employee_id) AS full_name
    FROM live l LEFT JOIN o_known k ON k.employee_id = l.employee_id
)
SELECT activity_id, employee_id, full_name FROM named
