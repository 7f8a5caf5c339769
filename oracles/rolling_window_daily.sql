WITH came AS (
    SELECT employee_id, start_at,
           CAST(start_at AS DATE) + CASE WHEN activity_id % 11 = 0 THEN 3 ELSE 0 END AS arrived_on
    FROM o_activities
), days AS (
    SELECT CAST(unnest(range(DATE '2024-01-24', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS as_of
)
SELECT employee_id, count(*) AS activities_count_12m, strftime(as_of, '%Y-%m-%d') AS as_of
FROM came JOIN days ON arrived_on <= as_of AND start_at >= as_of - INTERVAL 10 DAY
GROUP BY employee_id, as_of
