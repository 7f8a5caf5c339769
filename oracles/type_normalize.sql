SELECT c_custkey,
       TRY_CAST(CASE WHEN c_custkey % 50 = 0 THEN 'x' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS BIGINT)
           AS employee_id,
       CAST(TRY_CAST(CASE WHEN c_custkey % 40 = 0 THEN '1990-02-30'
                          ELSE CAST(DATE '1960-01-01' + CAST((c_custkey * 37) % 15000 AS INTEGER) AS VARCHAR) END
                     AS DATE) AS VARCHAR) AS birth_date,
       CAST(CAST(c_acctbal AS DECIMAL(12, 2)) AS DOUBLE) AS balance,
       TRY_CAST(CAST(c_custkey % 7 AS VARCHAR) AS INTEGER) AS paid_leave_days
FROM customer
