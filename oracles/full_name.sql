SELECT c_custkey AS employee_id, split_part(c_name, '#', 1) || ' ' || split_part(c_name, '#', 2) AS full_name
FROM customer
