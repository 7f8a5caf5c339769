SELECT employee_id, count(*) AS activities_count_12m
FROM o_activities
WHERE start_at >= DATE '2024-01-31' - INTERVAL 10 DAY
GROUP BY employee_id
