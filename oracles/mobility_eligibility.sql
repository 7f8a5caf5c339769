SELECT e.employee_id, e.transport_mode, d.home_to_office_km,
       coalesce((e.transport_mode = 'Marche/running' AND d.home_to_office_km <= 15)
             OR (e.transport_mode = 'Vélo/Trottinette/Autres' AND d.home_to_office_km <= 25), false)
           AS is_eligible_premium
FROM o_employees e LEFT JOIN o_distances d ON d.home_address = e.home_address
