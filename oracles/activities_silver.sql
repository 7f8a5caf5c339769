SELECT a.activity_id, a.employee_id, e.first_name || ' ' || e.last_name AS full_name, e.business_unit,
       a.sport_type, a.start_at, a.end_at,
       a.distance_m / 1000.0 AS distance_km,
       a.duration_s / 60.0 AS duration_min,
       a.comment, a.source,
       CASE WHEN a.distance_m > 0
            THEN CAST(round(CAST((a.duration_s / 60.0) / (a.distance_m / 1000.0) AS DECIMAL(20, 6)), 2) AS DOUBLE)
       END AS pace_min_per_km,
       '2024-01-31' AS extract_date
FROM o_activities a LEFT JOIN o_employees e ON e.employee_id = a.employee_id
