SELECT CASE WHEN NOT (event_id % 401 = 0 OR event_id % 107 = 0) THEN user_id END AS employee_id,
       CASE WHEN NOT (event_id % 401 = 0 OR event_id % 107 = 0) THEN event_type END AS business_unit,
       CASE WHEN (event_id % 401 = 0 OR event_id % 107 = 0) THEN NULL
            ELSE CASE event_id % 4 WHEN 0 THEN 'Marche/running' WHEN 1 THEN 'Vélo/Trottinette/Autres'
                      WHEN 2 THEN 'véhicule thermique/électrique' ELSE 'Transports en commun' END END AS transport_mode,
       CASE WHEN NOT (event_id % 401 = 0 OR event_id % 107 = 0) THEN 'NATION_' || (event_id % 25) END AS home_address,
       CASE WHEN NOT (event_id % 401 = 0 OR event_id % 107 = 0) THEN 20000.0 + value * 100 END AS gross_salary,
       CASE WHEN event_id % 401 = 0 THEN 't'
            ELSE CASE event_id % 10 WHEN 7 THEN 'r' WHEN 8 THEN 'u' WHEN 9 THEN 'd' ELSE 'c' END END AS __op,
       (epoch_us(ts) // 1000) AS __source_ts_ms,
       event_id AS __source_lsn,
       event_id % 10 = 9 AND event_id % 401 <> 0 AS __deleted
FROM events
