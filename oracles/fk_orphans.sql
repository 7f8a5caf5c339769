SELECT a.activity_id, a.employee_id
FROM o_activities a
WHERE a.activity_id % 89 <> 0 AND NOT EXISTS (SELECT 1 FROM o_known k WHERE k.employee_id = a.employee_id)
