SELECT employee_id, first_name, last_name, CAST(hire_date AS VARCHAR) AS hire_date
FROM o_employees ORDER BY employee_id
