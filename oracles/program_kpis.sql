WITH s AS (
    SELECT count(*) AS employees,
           CAST(sum(CAST(total_cost AS DECIMAL(20, 2))) AS DOUBLE) AS total_cost,
           CAST(sum(CAST(gross_salary AS DECIMAL(20, 2))) AS DOUBLE) AS payroll,
           CAST(count_if(is_eligible_premium) AS BIGINT) AS bonus_count,
           CAST(count_if(is_eligible_wellbeing) AS BIGINT) AS wellbeing_count,
           CAST(count_if(distance_check_status = 'ok') AS BIGINT) AS distances_resolved,
           CAST(sum(activities_count_12m) AS BIGINT) AS activities
    FROM o_gold
)
SELECT employees, total_cost, payroll,
       CAST(round(CAST(total_cost * 100.0 / payroll AS DECIMAL(20, 6)), 2) AS DOUBLE) AS cost_pct_payroll,
       bonus_count,
       CAST(round(CAST(CAST(bonus_count AS DOUBLE) * 100.0 / employees AS DECIMAL(20, 6)), 2) AS DOUBLE) AS bonus_pct,
       wellbeing_count,
       CAST(round(CAST(CAST(wellbeing_count AS DOUBLE) * 100.0 / employees AS DECIMAL(20, 6)), 2) AS DOUBLE)
           AS wellbeing_pct,
       distances_resolved, activities
FROM s
