SELECT CASE WHEN event_id % 401 = 0 THEN 't'
            ELSE CASE event_id % 10 WHEN 7 THEN 'r' WHEN 8 THEN 'u' WHEN 9 THEN 'd' ELSE 'c' END END AS __op,
       (epoch_us(ts) // 1000) AS __source_ts_ms,
       event_id AS __source_lsn,
       CASE WHEN event_id % 401 = 0 THEN 'truncate' ELSE 'no key in the row image' END AS reason
FROM events
WHERE event_id % 401 = 0 OR event_id % 107 = 0
