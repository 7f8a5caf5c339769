SELECT employee_id, last_name, first_name, CAST(birth_date AS VARCHAR) AS birth_date, business_unit,
       CAST(gross_salary AS DOUBLE) AS gross_salary, contract_type, paid_leave_days, home_address, transport_mode,
       '2024-01-31' AS extract_date
FROM o_employees
