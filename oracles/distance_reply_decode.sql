WITH a AS (
    SELECT 'NATION_' || n_nationkey AS home_address, n_nationkey AS k,
           n_nationkey * 1250 + CASE WHEN n_nationkey = 20 THEN 5 ELSE 0 END AS metres
    FROM nation
    UNION ALL
    SELECT 'HOME_' || c_custkey, c_custkey, (c_custkey * 37) % 60000 FROM customer
), r AS (
    SELECT home_address,
           CASE k % 10
               WHEN 9 THEN '{"status":"OK","rows":[{"elements":[{"status":"NOT_FOUND"}]}]}'
               WHEN 8 THEN '{"status":"REQUEST_DENIED","error_message":"key rejected","rows":[]}'
               WHEN 7 THEN '<html>bad gateway</html>'
               WHEN 6 THEN NULL
               WHEN 5 THEN '{"status":"OK","rows":[]}'
               ELSE '{"status":"OK","rows":[{"elements":[{"status":"OK","distance":{"value":'
                    || metres || '}}]}]}'
           END AS reply
    FROM a
), j AS (
    SELECT home_address, reply, CASE WHEN json_valid(reply) THEN reply END AS doc FROM r
), f AS (
    SELECT home_address, reply,
           json_extract_string(doc, '$.status') AS st,
           json_extract(doc, '$.rows[0].elements[0]') AS el
    FROM j
), g AS (
    SELECT *, json_extract_string(el, '$.status') AS el_st,
           CAST(json_extract(el, '$.distance.value') AS BIGINT) AS metres
    FROM f
), s AS (
    SELECT *,
           CASE WHEN reply IS NULL THEN 'no_api_key'
                WHEN coalesce(st, '') <> 'OK' THEN 'error'
                WHEN el IS NULL THEN 'error'
                WHEN coalesce(el_st, '') <> 'OK' THEN 'not_found'
                WHEN metres IS NULL THEN 'error'
                ELSE 'ok' END AS distance_check_status
    FROM g
)
SELECT home_address,
       CASE WHEN distance_check_status = 'ok'
            THEN CAST(printf('%.2f', metres / 1000.0::DOUBLE) AS DOUBLE) END AS home_to_office_km,
       distance_check_status
FROM s
