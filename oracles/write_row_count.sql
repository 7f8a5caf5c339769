SELECT 'silver_activities' AS table_name, count(*) AS rows_written, count(*) AS rows_read FROM events
