WITH live AS (
    SELECT * FROM o_messages WHERE __op = 'c' AND source = 'live' AND employee_id IS NOT NULL
), named AS (
    SELECT l.*, coalesce(k.first_name || ' ' || k.last_name, 'Employé #' || l.employee_id) AS full_name
    FROM live l LEFT JOIN o_known k ON k.employee_id = l.employee_id
), parts AS (
    SELECT *, lower(sport_type) AS sl, duration_s // 60 AS mins,
           replace(printf('%.1f', distance_m / 1000.0), '.', ',') AS dist,
           CASE sport_type WHEN 'Course à pied' THEN 'courir' WHEN 'Vélo' THEN 'rouler'
                           WHEN 'Marche' THEN 'marcher' WHEN 'Randonnée' THEN 'randonner'
                           WHEN 'Natation' THEN 'nager' ELSE 'faire' END AS verb,
           CASE sport_type WHEN 'Course à pied' THEN '🏃' WHEN 'Vélo' THEN '🚴' WHEN 'Marche' THEN '🚶'
                           WHEN 'Randonnée' THEN '🥾' WHEN 'Natation' THEN '🏊' WHEN 'Escalade' THEN '🧗'
                           WHEN 'Yoga' THEN '🧘' WHEN 'Fitness' THEN '💪' WHEN 'Tennis' THEN '🎾'
                           ELSE '🏅' END AS emoji,
           coalesce(distance_m > 0, false) AS has_dist
    FROM named
), worded AS (
    SELECT *,
           CASE WHEN sport_type IS NULL OR duration_s IS NULL OR (NOT has_dist AND length(sport_type) = 0) THEN NULL
                ELSE (CASE WHEN has_dist AND verb = 'faire'
                           THEN 'Bravo ' || full_name || ' ! Tu viens de faire ' || mins || ' min de ' || sl
                                || ' sur ' || dist || ' km !'
                           WHEN has_dist
                           THEN 'Bravo ' || full_name || ' ! Tu viens de ' || verb || ' ' || dist || ' km en '
                                || mins || ' min !'
                           ELSE 'Bravo ' || full_name || ' ! ' || mins || ' min '
                                || CASE WHEN left(sl, 1) IN ('a', 'e', 'i', 'o', 'u', 'é', 'è', 'à', 'â')
                                        THEN 'd''' ELSE 'de ' END
                                || sl || ' bouclées !' END)
                     || ' ' || emoji
                     || CASE WHEN comment IS NOT NULL AND comment <> '' THEN ' ("' || comment || '")' ELSE '' END
           END AS text,
           CASE WHEN sport_type IS NULL THEN 'missing sport_type'
                WHEN duration_s IS NULL THEN 'missing duration_s'
                WHEN NOT has_dist AND length(sport_type) = 0 THEN 'empty sport_type' END AS reason
    FROM parts
)
SELECT activity_id, employee_id, text FROM worded WHERE text IS NOT NULL
