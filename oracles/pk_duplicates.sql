SELECT 'orders' AS table_name, 'o_custkey' AS key_columns, CAST(o_custkey AS VARCHAR) AS key_value, count(*) AS n
FROM orders GROUP BY o_custkey HAVING count(*) > 1
UNION ALL
SELECT 'employees', 'employee_id', CAST(employee_id AS VARCHAR), count(*)
FROM (SELECT employee_id FROM o_employees UNION ALL SELECT employee_id FROM o_employees WHERE employee_id % 17 = 0) e
GROUP BY employee_id HAVING count(*) > 1
UNION ALL
SELECT 'activities', 'activity_id', CAST(activity_id AS VARCHAR), count(*) FROM o_activities GROUP BY activity_id HAVING count(*) > 1
UNION ALL
SELECT 'employee_eligibility', 'snapshot_date,employee_id', '2024-01-31,' || employee_id, count(*)
FROM o_gold GROUP BY employee_id HAVING count(*) > 1
