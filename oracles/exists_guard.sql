SELECT EXISTS (SELECT 1 FROM customer) AS employees_exist,
       EXISTS (SELECT 1 FROM o_activities WHERE source = 'historical') AS historical_activities_exist,
       EXISTS (SELECT 1 FROM events WHERE ts > DATE '2024-01-31') AS future_activities_exist
