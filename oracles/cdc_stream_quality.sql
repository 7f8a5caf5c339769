SELECT 'activity_id_not_null' AS rule, 'activity_id' AS "column", 'values_not_null' AS kind, count(*) AS evaluated,
       CAST(count_if(activity_id IS NULL) AS BIGINT) AS failed, count_if(activity_id IS NULL) = 0 AS success
FROM o_messages
UNION ALL
SELECT 'employee_id_not_null', 'employee_id', 'values_not_null', count(*),
       CAST(count_if(employee_id IS NULL) AS BIGINT), count_if(employee_id IS NULL) = 0
FROM o_messages
UNION ALL
SELECT 'sport_type_not_null', 'sport_type', 'values_not_null', count(*),
       CAST(count_if(sport_type IS NULL) AS BIGINT), count_if(sport_type IS NULL) = 0
FROM o_messages
UNION ALL
SELECT 'source_in_set', 'source', 'values_in_set', count(source),
       CAST(count_if(source NOT IN ('live', 'historical')) AS BIGINT), count_if(source NOT IN ('live', 'historical')) = 0
FROM o_messages
UNION ALL
SELECT 'duration_s_between', 'duration_s', 'values_between', count(duration_s),
       CAST(count_if(duration_s < 1 OR duration_s > 14400) AS BIGINT), count_if(duration_s < 1 OR duration_s > 14400) = 0
FROM o_messages
