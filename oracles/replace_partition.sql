SELECT activity_id, employee_id, sport_type, start_at, end_at, distance_m, duration_s, comment, source,
       CAST(CAST(start_at AS DATE) AS VARCHAR) AS extract_date
FROM o_activities
