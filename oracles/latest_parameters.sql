WITH days AS (
    SELECT DISTINCT CAST(ts AS DATE) AS day FROM events
), params(snapshot_date, premium_rate, wellbeing_threshold, wellbeing_days, max_distance_walk_km,
          max_distance_bike_km) AS (
    VALUES (DATE '2023-06-01', 0.04, 20, 3, 10, 20),
           (DATE '2024-01-01', 0.05, 15, 5, 15, 25),
           (DATE '2024-06-01', 0.08, 10, 7, 20, 30)
)
SELECT CAST(d.day AS VARCHAR) AS day, CAST(p.snapshot_date AS VARCHAR) AS snapshot_date,
       CAST(p.premium_rate AS DOUBLE) AS premium_rate, p.wellbeing_threshold, p.wellbeing_days,
       p.max_distance_walk_km, p.max_distance_bike_km
FROM days d ASOF LEFT JOIN params p ON d.day >= p.snapshot_date
