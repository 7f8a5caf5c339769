SELECT c_custkey AS employee_id, CAST(NULL AS BIGINT) AS first_order, 'existing' AS origin
FROM customer WHERE c_custkey % 2 = 0
UNION ALL
SELECT o_custkey, min(o_orderkey), 'inserted'
FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey % 2 = 0 AND c.c_custkey = o.o_custkey)
GROUP BY o_custkey
