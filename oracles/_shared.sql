o_first_orders AS (
    SELECT o_custkey AS employee_id, min(CAST(o_orderdate AS DATE)) AS first_order_date
    FROM orders GROUP BY o_custkey
),
o_employees AS (
    SELECT c_custkey AS employee_id,
           split_part(c_name, '#', 2) AS last_name,
           split_part(c_name, '#', 1) AS first_name,
           DATE '1960-01-01' + CAST((c_custkey * 37) % 15000 AS INTEGER) AS birth_date,
           c_mktsegment AS business_unit,
           coalesce(f.first_order_date, DATE '1995-01-01') AS hire_date,
           CAST(20000 + 8 * greatest(c_acctbal, 0) AS DECIMAL(10, 2)) AS gross_salary,
           CASE WHEN c_custkey % 5 = 0 THEN 'CDD' ELSE 'CDI' END AS contract_type,
           CAST(25 + c_custkey % 6 AS INTEGER) AS paid_leave_days,
           'NATION_' || c_nationkey AS home_address,
           CASE c_custkey % 4 WHEN 0 THEN 'Marche/running'
                              WHEN 1 THEN 'Vélo/Trottinette/Autres'
                              WHEN 2 THEN 'véhicule thermique/électrique'
                              ELSE 'Transports en commun' END AS transport_mode
    FROM customer LEFT JOIN o_first_orders f ON f.employee_id = c_custkey
),
o_known AS (
    SELECT * FROM o_employees WHERE employee_id % 13 <> 0
),
o_activities AS (
    SELECT event_id AS activity_id,
           user_id AS employee_id,
           CASE event_type WHEN 'click' THEN 'Course à pied' WHEN 'view' THEN 'Vélo'
                           WHEN 'error' THEN 'Yoga' WHEN 'signup' THEN 'Escalade'
                           WHEN 'purchase' THEN 'Tennis' END AS sport_type,
           ts AS start_at,
           ts + to_seconds(CAST(60 + floor(value * 60) AS BIGINT)) AS end_at,
           CASE WHEN event_type NOT IN ('error', 'signup')
                THEN CAST(json_extract_string(props, '$.k') AS INTEGER) * 100 END AS distance_m,
           CAST(60 + floor(value * 60) AS INTEGER) AS duration_s,
           CASE WHEN event_id % 3 = 0 THEN 'note ' || event_id END AS comment,
           CASE WHEN event_id % 2 = 0 THEN 'live' ELSE 'historical' END AS source
    FROM events
),
o_messages AS (
    SELECT CASE WHEN bad THEN NULL ELSE activity_id END AS activity_id,
           CASE WHEN bad OR activity_id % 89 = 0 THEN NULL ELSE employee_id END AS employee_id,
           CASE WHEN bad OR activity_id % 97 = 0 THEN NULL ELSE sport_type END AS sport_type,
           CASE WHEN bad THEN NULL ELSE CAST((epoch_us(start_at) // 1000) AS VARCHAR) END AS start_at,
           CASE WHEN bad THEN NULL ELSE CAST((epoch_us(end_at) // 1000) AS VARCHAR) END AS end_at,
           CASE WHEN bad THEN NULL ELSE distance_m END AS distance_m,
           CASE WHEN bad THEN NULL ELSE duration_s END AS duration_s,
           CASE WHEN bad THEN NULL ELSE comment END AS comment,
           CASE WHEN bad THEN NULL ELSE source END AS source,
           CASE WHEN bad THEN NULL
                WHEN activity_id % 10 = 7 THEN 'r' WHEN activity_id % 10 = 8 THEN 'u'
                WHEN activity_id % 10 = 9 THEN 'd' ELSE 'c' END AS __op,
           CASE WHEN bad THEN NULL ELSE (epoch_us(end_at) // 1000) END AS __source_ts_ms
    FROM (SELECT *, activity_id % 101 = 0 AS bad FROM o_activities) m
),
o_distances AS (
    SELECT 'NATION_' || n_nationkey AS home_address,
           CASE WHEN n_nationkey % 10 <= 4
                THEN CAST(printf('%.2f', (n_nationkey * 1250 + CASE WHEN n_nationkey = 20 THEN 5 ELSE 0 END) / 1000.0::DOUBLE) AS DOUBLE)
           END AS home_to_office_km,
           CASE WHEN n_nationkey % 10 <= 4 THEN 'ok'
                WHEN n_nationkey % 10 = 9 THEN 'not_found'
                WHEN n_nationkey % 10 = 6 THEN 'no_api_key'
                ELSE 'error' END AS distance_check_status
    FROM nation
),
o_counts_365 AS (
    SELECT employee_id, count(*) AS n FROM o_activities
    WHERE start_at >= DATE '2024-01-31' - INTERVAL 365 DAY GROUP BY employee_id
),
o_gold AS (
    SELECT employee_id, full_name, business_unit, contract_type, gross_salary, transport_mode,
           home_to_office_km, distance_check_status, is_eligible_premium, premium_amount,
           activities_count_12m, is_eligible_wellbeing,
           CASE WHEN is_eligible_wellbeing THEN 5 ELSE 0 END AS wellbeing_days,
           wellbeing_cost,
           CAST(round(CAST(premium_amount + wellbeing_cost AS DECIMAL(20, 6)), 2) AS DOUBLE) AS total_cost
    FROM (
        SELECT *,
               CASE WHEN is_eligible_premium
                    THEN CAST(round(CAST(gross_salary * 0.05 AS DECIMAL(20, 6)), 2) AS DOUBLE) ELSE 0.0 END
                   AS premium_amount,
               CASE WHEN is_eligible_wellbeing
                    THEN CAST(round(CAST(gross_salary / 365.0 * 5 AS DECIMAL(20, 6)), 2) AS DOUBLE) ELSE 0.0 END
                   AS wellbeing_cost
        FROM (
            SELECT e.employee_id, e.first_name || ' ' || e.last_name AS full_name, e.business_unit,
                   e.contract_type, CAST(e.gross_salary AS DOUBLE) AS gross_salary, e.transport_mode,
                   d.home_to_office_km, d.distance_check_status,
                   coalesce(c.n, 0) AS activities_count_12m,
                   coalesce((e.transport_mode = 'Marche/running' AND d.home_to_office_km <= 15)
                         OR (e.transport_mode = 'Vélo/Trottinette/Autres' AND d.home_to_office_km <= 25), false)
                       AS is_eligible_premium,
                   coalesce(c.n, 0) >= 15 AS is_eligible_wellbeing
            FROM o_employees e
            LEFT JOIN o_distances d ON d.home_address = e.home_address
            LEFT JOIN o_counts_365 c ON c.employee_id = e.employee_id
        ) b
    ) m
)
