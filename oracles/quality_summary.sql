WITH r AS (
    SELECT 'row_count_equal' AS rule,
           (SELECT count(*) FROM o_gold) = (SELECT count(*) FROM customer) AS ok
    UNION ALL SELECT 'total_cost_between', CAST(count_if(total_cost < 0 OR total_cost > 10000) AS BIGINT) = 0 FROM o_gold
    UNION ALL SELECT 'gross_salary_between', CAST(count_if(gross_salary < 20000 OR gross_salary > 100000) AS BIGINT) = 0 FROM o_gold
    UNION ALL SELECT 'business_unit_in_set',
                     CAST(count_if(business_unit NOT IN ('Finance', 'Support', 'Ventes', 'Marketing', 'R&D')) AS BIGINT) = 0
              FROM o_gold
    UNION ALL SELECT 'employee_id_not_null', CAST(count_if(employee_id IS NULL) AS BIGINT) = 0 FROM o_gold
)
SELECT bool_and(ok) AS success, CAST(count_if(ok) AS BIGINT) AS successful_rules, count(*) AS evaluated_rules,
       coalesce(string_agg(CASE WHEN NOT ok THEN rule END, ',' ORDER BY rule), '') AS failed_rules
FROM r
