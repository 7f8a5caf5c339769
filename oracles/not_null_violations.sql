SELECT 'activity_changes' AS table_name, 'activity_id' AS column_name, count(*) AS checked_rows, CAST(count_if(activity_id IS NULL) AS BIGINT) AS nulls FROM o_messages
UNION ALL
SELECT 'activity_changes' AS table_name, 'employee_id' AS column_name, count(*) AS checked_rows, CAST(count_if(employee_id IS NULL) AS BIGINT) AS nulls FROM o_messages
UNION ALL
SELECT 'activity_changes' AS table_name, 'sport_type' AS column_name, count(*) AS checked_rows, CAST(count_if(sport_type IS NULL) AS BIGINT) AS nulls FROM o_messages
UNION ALL
SELECT 'activity_changes' AS table_name, 'start_at' AS column_name, count(*) AS checked_rows, CAST(count_if(start_at IS NULL) AS BIGINT) AS nulls FROM o_messages
UNION ALL
SELECT 'activity_changes' AS table_name, 'end_at' AS column_name, count(*) AS checked_rows, CAST(count_if(end_at IS NULL) AS BIGINT) AS nulls FROM o_messages
UNION ALL
SELECT 'activity_changes' AS table_name, 'duration_s' AS column_name, count(*) AS checked_rows, CAST(count_if(duration_s IS NULL) AS BIGINT) AS nulls FROM o_messages
UNION ALL
SELECT 'activity_changes' AS table_name, 'source' AS column_name, count(*) AS checked_rows, CAST(count_if(source IS NULL) AS BIGINT) AS nulls FROM o_messages
UNION ALL
SELECT 'employees', 'employee_id', count(*), CAST(count_if(employee_id IS NULL) AS BIGINT) FROM o_employees
UNION ALL
SELECT 'employees', 'last_name', count(*), CAST(count_if(last_name IS NULL) AS BIGINT) FROM o_employees
UNION ALL
SELECT 'employees', 'first_name', count(*), CAST(count_if(first_name IS NULL) AS BIGINT) FROM o_employees
UNION ALL
SELECT 'employees', 'birth_date', count(*), CAST(count_if(birth_date IS NULL) AS BIGINT) FROM o_employees
UNION ALL
SELECT 'employees', 'business_unit', count(*), CAST(count_if(business_unit IS NULL) AS BIGINT) FROM o_employees
UNION ALL
SELECT 'employees', 'hire_date', count(*), CAST(count_if(hire_date IS NULL) AS BIGINT) FROM o_employees
UNION ALL
SELECT 'employees', 'gross_salary', count(*), CAST(count_if(gross_salary IS NULL) AS BIGINT) FROM o_employees
UNION ALL
SELECT 'employees', 'contract_type', count(*), CAST(count_if(contract_type IS NULL) AS BIGINT) FROM o_employees
UNION ALL
SELECT 'employees', 'paid_leave_days', count(*), CAST(count_if(paid_leave_days IS NULL) AS BIGINT) FROM o_employees
UNION ALL
SELECT 'employees', 'home_address', count(*), CAST(count_if(employee_id % 19 = 0 OR home_address IS NULL) AS BIGINT) FROM o_employees
UNION ALL
SELECT 'employees', 'transport_mode', count(*), CAST(count_if(transport_mode IS NULL) AS BIGINT) FROM o_employees
UNION ALL
SELECT 'employee_eligibility', 'snapshot_date', count(*), CAST(0 AS BIGINT) FROM o_gold
UNION ALL
SELECT 'employee_eligibility', 'employee_id', count(*), CAST(count_if(employee_id IS NULL) AS BIGINT) FROM o_gold
UNION ALL
SELECT 'employee_eligibility', 'is_eligible_premium', count(*), CAST(count_if(is_eligible_premium IS NULL) AS BIGINT) FROM o_gold
UNION ALL
SELECT 'employee_eligibility', 'premium_amount', count(*), CAST(count_if(premium_amount IS NULL) AS BIGINT) FROM o_gold
UNION ALL
SELECT 'employee_eligibility', 'activities_count_12m', count(*), CAST(count_if(activities_count_12m IS NULL) AS BIGINT) FROM o_gold
UNION ALL
SELECT 'employee_eligibility', 'is_eligible_wellbeing', count(*), CAST(count_if(is_eligible_wellbeing IS NULL) AS BIGINT) FROM o_gold
UNION ALL
SELECT 'employee_eligibility', 'wellbeing_days', count(*), CAST(count_if(wellbeing_days IS NULL) AS BIGINT) FROM o_gold
UNION ALL
SELECT 'employee_eligibility', 'wellbeing_cost', count(*), CAST(count_if(wellbeing_cost IS NULL) AS BIGINT) FROM o_gold
UNION ALL
SELECT 'employee_eligibility', 'total_cost', count(*), CAST(count_if(total_cost IS NULL) AS BIGINT) FROM o_gold
