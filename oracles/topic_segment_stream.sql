SELECT CAST(activity_id % 4 AS INTEGER) AS topic_partition, activity_id // 4 AS topic_offset, *
FROM o_messages WHERE __op = 'c' AND source = 'live' AND employee_id IS NOT NULL
