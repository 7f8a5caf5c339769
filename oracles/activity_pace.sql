SELECT activity_id, distance_m / 1000.0 AS distance_km, duration_s / 60.0 AS duration_min,
       CASE WHEN distance_m > 0
            THEN CAST(round(CAST((duration_s / 60.0) / (distance_m / 1000.0) AS DECIMAL(20, 6)), 2) AS DOUBLE)
       END AS pace_min_per_km
FROM o_activities
