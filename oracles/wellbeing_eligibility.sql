WITH cnt AS (
    SELECT employee_id, count(*) AS n FROM o_activities
    WHERE start_at >= DATE '2024-01-31' - INTERVAL 10 DAY GROUP BY employee_id
)
SELECT c.c_custkey AS employee_id, coalesce(cnt.n, 0) AS activities_count_12m,
       coalesce(cnt.n, 0) >= 15 AS is_eligible_wellbeing
FROM customer c LEFT JOIN cnt ON cnt.employee_id = c.c_custkey
