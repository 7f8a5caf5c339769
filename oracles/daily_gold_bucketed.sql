-- Gold eligibility restated from the raw tables.
WITH emp AS (
    SELECT c_custkey AS employee_id,
           split_part(c_name, '#', 1) || ' ' || split_part(c_name, '#', 2) AS full_name,
           c_mktsegment AS business_unit,
           CASE WHEN c_custkey % 5 = 0 THEN 'CDD' ELSE 'CDI' END AS contract_type,
           CAST(CAST(20000 + 8 * greatest(c_acctbal, 0) AS DECIMAL(10, 2)) AS DOUBLE) AS gross_salary,
           CASE c_custkey % 4 WHEN 0 THEN 'Marche/running'
                              WHEN 1 THEN 'Vélo/Trottinette/Autres'
                              WHEN 2 THEN 'véhicule thermique/électrique'
                              ELSE 'Transports en commun' END AS transport_mode,
           c_nationkey AS nk
    FROM customer
), dist AS (
    SELECT n_nationkey AS nk,
           CASE WHEN n_nationkey % 10 <= 4 THEN CAST(n_nationkey * 1.25 AS DOUBLE) END AS km,
           CASE WHEN n_nationkey % 10 <= 4 THEN 'ok'
                WHEN n_nationkey % 10 = 9 THEN 'not_found'
                WHEN n_nationkey % 10 = 6 THEN 'no_api_key'
                ELSE 'error' END AS status
    FROM nation
), cnt AS (
    SELECT user_id AS employee_id, count(*) AS n
    FROM events
    WHERE ts >= DATE '2024-01-31' - INTERVAL 365 DAY
    GROUP BY user_id
), base AS (
    SELECT e.*, d.km AS home_to_office_km, d.status AS distance_check_status,
           coalesce(c.n, 0) AS activities_count_12m
    FROM emp e
    LEFT JOIN dist d ON e.nk = d.nk
    LEFT JOIN cnt c ON e.employee_id = c.employee_id
), flags AS (
    SELECT *,
           coalesce((transport_mode = 'Marche/running' AND home_to_office_km <= 15)
                 OR (transport_mode = 'Vélo/Trottinette/Autres' AND home_to_office_km <= 25), false)
               AS is_eligible_premium,
           activities_count_12m >= 15 AS is_eligible_wellbeing
    FROM base
), money AS (
    SELECT *,
           CASE WHEN is_eligible_premium
                THEN CAST(round(CAST(gross_salary * 0.05 AS DECIMAL(20, 6)), 2) AS DOUBLE) ELSE 0.0 END
               AS premium_amount,
           CASE WHEN is_eligible_wellbeing THEN 5 ELSE 0 END AS wellbeing_days,
           CASE WHEN is_eligible_wellbeing
                THEN CAST(round(CAST(gross_salary / 365.0 * 5 AS DECIMAL(20, 6)), 2) AS DOUBLE) ELSE 0.0 END
               AS wellbeing_cost
    FROM flags
)
SELECT '2024-01-31' AS snapshot_date, employee_id, full_name, business_unit, contract_type,
       gross_salary, transport_mode, home_to_office_km, distance_check_status,
       is_eligible_premium, premium_amount, activities_count_12m, is_eligible_wellbeing,
       wellbeing_days, wellbeing_cost,
       CAST(round(CAST(premium_amount + wellbeing_cost AS DECIMAL(20, 6)), 2) AS DOUBLE) AS total_cost
FROM money
