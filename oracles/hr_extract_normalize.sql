SELECT employee_id, last_name, first_name, CAST(birth_date AS VARCHAR) AS birth_date, business_unit,
       CAST(hire_date AS VARCHAR) AS hire_date, CAST(gross_salary AS DOUBLE) AS gross_salary, contract_type,
       paid_leave_days, home_address, transport_mode
FROM o_employees
