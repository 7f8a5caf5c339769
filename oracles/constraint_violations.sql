SELECT 'employees' AS table_name, 'chk_contract_type' AS constraint_name, count(*) AS checked_rows,
       CAST(count_if(NOT (contract_type IN ('CDI', 'CDD'))) AS BIGINT) AS violations FROM o_employees
UNION ALL
SELECT 'employees', 'chk_transport_mode', count(*),
       CAST(count_if(NOT (transport_mode IN ('Marche/running', 'Vélo/Trottinette/Autres',
                                        'véhicule thermique/électrique', 'Transports en commun'))) AS BIGINT)
FROM o_employees
UNION ALL
SELECT 'activities', 'chk_distance_positive', count(*), CAST(count_if(NOT (distance_m IS NULL OR distance_m >= 0)) AS BIGINT)
FROM o_activities
UNION ALL
SELECT 'activities', 'chk_duration_positive', count(*), CAST(count_if(NOT (duration_s > 0)) AS BIGINT) FROM o_activities
UNION ALL
SELECT 'activities', 'chk_dates_coherent', count(*), CAST(count_if(NOT (end_at > start_at)) AS BIGINT) FROM o_activities
UNION ALL
SELECT 'activities', 'chk_source_valid', count(*), CAST(count_if(NOT (source IN ('historical', 'live'))) AS BIGINT) FROM o_activities
UNION ALL
SELECT 'customer', 'balance_non_negative', count(*), CAST(count_if(NOT (c_acctbal >= 0)) AS BIGINT) FROM customer
