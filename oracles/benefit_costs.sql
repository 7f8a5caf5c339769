-- Default parameters, 10-day activity window.
SELECT employee_id, premium_amount, wellbeing_days, wellbeing_cost, total_cost FROM (
WITH cnt AS (
    SELECT employee_id, count(*) AS n FROM o_activities
    WHERE start_at >= DATE '2024-01-31' - INTERVAL 10 DAY GROUP BY employee_id
), b AS (
    SELECT e.employee_id, e.first_name || ' ' || e.last_name AS full_name, e.business_unit, e.contract_type,
           CAST(e.gross_salary AS DOUBLE) AS gross_salary, e.transport_mode, d.home_to_office_km,
           d.distance_check_status, coalesce(c.n, 0) AS activities_count_12m
    FROM o_employees e
    LEFT JOIN o_distances d ON d.home_address = e.home_address
    LEFT JOIN cnt c ON c.employee_id = e.employee_id
), f AS (
    SELECT *,
           coalesce((transport_mode = 'Marche/running' AND home_to_office_km <= 15)
                 OR (transport_mode = 'Vélo/Trottinette/Autres' AND home_to_office_km <= 25), false)
               AS is_eligible_premium,
           activities_count_12m >= 15 AS is_eligible_wellbeing
    FROM b
), m AS (
    SELECT *,
           CASE WHEN is_eligible_premium
                THEN CAST(round(CAST(gross_salary * 0.05 AS DECIMAL(20, 6)), 2) AS DOUBLE) ELSE 0.0 END
               AS premium_amount,
           CASE WHEN is_eligible_wellbeing THEN 5 ELSE 0 END AS wellbeing_days,
           CASE WHEN is_eligible_wellbeing
                THEN CAST(round(CAST(gross_salary / 365.0 * 5 AS DECIMAL(20, 6)), 2) AS DOUBLE) ELSE 0.0 END
               AS wellbeing_cost
    FROM f
)
SELECT '2024-01-31' AS snapshot_date, employee_id, full_name, business_unit, contract_type, gross_salary,
       transport_mode, home_to_office_km, distance_check_status, is_eligible_premium, premium_amount,
       activities_count_12m, is_eligible_wellbeing, wellbeing_days, wellbeing_cost,
       CAST(round(CAST(premium_amount + wellbeing_cost AS DECIMAL(20, 6)), 2) AS DOUBLE) AS total_cost
FROM m
) g
