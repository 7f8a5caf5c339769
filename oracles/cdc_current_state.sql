WITH ranked AS (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events
    WHERE event_id > (SELECT max(event_id) FROM events WHERE event_id % 401 = 0) AND event_id % 107 <> 0
)
SELECT user_id AS employee_id, event_type AS business_unit,
       CASE event_id % 4 WHEN 0 THEN 'Marche/running' WHEN 1 THEN 'Vélo/Trottinette/Autres'
                         WHEN 2 THEN 'véhicule thermique/électrique' ELSE 'Transports en commun' END AS transport_mode,
       'NATION_' || (event_id % 25) AS home_address,
       20000.0 + value * 100 AS gross_salary,
       event_id AS __source_lsn,
       make_timestamp((epoch_us(ts) // 1000) * 1000) AS updated_at
FROM ranked
WHERE rn = 1 AND event_id % 10 <> 9
