SELECT 'row_count_equal' AS rule, CAST(NULL AS VARCHAR) AS "column", 'table_row_count' AS kind,
       count(*) AS evaluated, CAST(abs(count(*) - (SELECT count(*) FROM customer)) AS BIGINT) AS failed,
       count(*) = (SELECT count(*) FROM customer) AS success
FROM o_gold
UNION ALL
SELECT 'total_cost_between', 'total_cost', 'values_between', count(total_cost),
       CAST(count_if(total_cost < 0 OR total_cost > 10000) AS BIGINT), CAST(count_if(total_cost < 0 OR total_cost > 10000) AS BIGINT) = 0
FROM o_gold
UNION ALL
SELECT 'gross_salary_between', 'gross_salary', 'values_between', count(gross_salary),
       CAST(count_if(gross_salary < 20000 OR gross_salary > 100000) AS BIGINT),
       CAST(count_if(gross_salary < 20000 OR gross_salary > 100000) AS BIGINT) = 0
FROM o_gold
UNION ALL
SELECT 'business_unit_in_set', 'business_unit', 'values_in_set', count(business_unit),
       CAST(count_if(business_unit NOT IN ('Finance', 'Support', 'Ventes', 'Marketing', 'R&D')) AS BIGINT),
       CAST(count_if(business_unit NOT IN ('Finance', 'Support', 'Ventes', 'Marketing', 'R&D')) AS BIGINT) = 0
FROM o_gold
UNION ALL
SELECT 'employee_id_not_null', 'employee_id', 'values_not_null', count(*),
       CAST(count_if(employee_id IS NULL) AS BIGINT), CAST(count_if(employee_id IS NULL) AS BIGINT) = 0
FROM o_gold
