SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS hire_date,
       date_sub('year', CAST(o_orderdate AS DATE), DATE '2001-12-31') AS seniority_years
FROM orders
