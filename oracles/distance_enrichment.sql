SELECT e.employee_id, e.home_address, d.home_to_office_km, d.distance_check_status
FROM o_employees e LEFT JOIN o_distances d ON d.home_address = e.home_address
