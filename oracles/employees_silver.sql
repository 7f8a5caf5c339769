SELECT e.employee_id, e.first_name || ' ' || e.last_name AS full_name, e.first_name, e.last_name,
       CAST(e.birth_date AS VARCHAR) AS birth_date, e.business_unit, CAST(e.hire_date AS VARCHAR) AS hire_date,
       CAST(e.gross_salary AS DOUBLE) AS gross_salary, e.contract_type, e.paid_leave_days, e.home_address,
       e.transport_mode, d.home_to_office_km, d.distance_check_status,
       date_sub('year', e.birth_date, DATE '2024-01-31') AS age,
       date_sub('year', e.hire_date, DATE '2024-01-31') AS seniority_years,
       '2024-01-31' AS extract_date
FROM o_employees e LEFT JOIN o_distances d ON d.home_address = e.home_address
