SELECT c.c_custkey AS employee_id, coalesce(n.n, 0) AS activities_count_12m
FROM customer c LEFT JOIN o_counts_365 n ON n.employee_id = c.c_custkey
