"""DuckDB SQL for the bindings of ``bindings.py`` (used inside oracle queries)."""

ITEMS = """
  SELECT l.*, o.o_custkey, o.o_orderdate, p.p_name, p.p_type, p.p_retailprice,
         CAST(o.o_custkey AS VARCHAR) AS mask_studentpersonkey,
         CAST(year(o.o_orderdate) AS VARCHAR) AS SchoolYearFall
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN part p ON l.l_partkey = p.p_partkey
"""

ILLUMINATE = f"""
  SELECT mask_studentpersonkey, SchoolYearFall,
         CAST(l_shipdate AS DATE) AS responsedatevalue,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
         p_name AS Standard_Subject,
         l_quantity AS Response_points,
         CAST(50.0 AS DOUBLE) AS Response_points_possible,
         l_quantity * CAST(2.0 AS DOUBLE) AS Response_percent_correct,
         (CAST(1.0 AS DOUBLE) - l_discount * CAST(10.0 AS DOUBLE)) * CAST(100.0 AS DOUBLE) AS Standard_percent_correct,
         CASE l_returnflag WHEN 'R' THEN 'Reteach' WHEN 'A' THEN 'Extension'
                           WHEN 'N' THEN 'Review & Practice' END AS condition,
         CAST(l_linenumber AS VARCHAR) AS GradeLevelDuringUnitTest
  FROM ({ITEMS}) it
"""

MILESTONE = f"""
  SELECT mask_studentpersonkey, SchoolYearFall,
         CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS TestingDateId,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
         p_type AS SubjectDesc, l_extendedprice AS ScaleScore,
         l_linenumber AS AchievementLevel, p_retailprice AS LexileScore
  FROM ({ITEMS}) it
"""

RIT = """
  SELECT CAST(user_id AS VARCHAR) AS mask_studentpersonkey,
         lpad(CAST(week(ts) AS VARCHAR), 2, '0') AS SchoolYearFall,
         ts, event_id,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS TestDurationMinutes,
         value AS TestRITScore,
         CAST(event_id % 100 AS DOUBLE) AS TestPercentile,
         least(value / CAST(5.0 AS DOUBLE), CAST(100.0 AS DOUBLE)) AS PercentCorrect,
         CASE event_type WHEN 'purchase' THEN 'High' WHEN 'click' THEN 'HiAvg' WHEN 'view' THEN 'Avg'
                         WHEN 'signup' THEN 'LoAvg' WHEN 'error' THEN 'Low' END AS AchievementQuintile
  FROM events
"""

SAT = """
  SELECT CAST(o_custkey AS VARCHAR) AS mask_studentpersonkey,
         CAST(year(o_orderdate) AS VARCHAR) AS SchoolYearFall,
         CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS TestingDateId,
         o_orderkey,
         CAST(floor(o_totalprice / CAST(1000.0 AS DOUBLE)) AS DOUBLE) AS MathScore,
         CAST(floor(fmod(o_totalprice, CAST(1000.0 AS DOUBLE))) AS DOUBLE) AS VerbalScore
  FROM orders WHERE o_orderpriority = '1-URGENT'
"""

ENROL = """
  SELECT CAST(py.o_custkey AS VARCHAR) AS mask_studentpersonkey,
         CAST(py.yr AS VARCHAR) AS SchoolYearNumberFall,
         CAST(c.c_nationkey AS BIGINT) AS SchoolDetailFCSId,
         CAST((c.c_nationkey + 1) % 25 AS BIGINT) AS SchoolDetailFCSIdNextYear,
         CAST(py.yr - 1990 + py.o_custkey % 3 AS VARCHAR) AS GradeLevel,
         CASE WHEN py.OrderStatus = 'P' THEN 'Y' ELSE 'N' END AS RetainedFlag,
         CASE c.c_mktsegment WHEN 'BUILDING' THEN 'Y' WHEN 'AUTOMOBILE' THEN 'D' END
             AS ActiveGiftedStudentResultRecordFlag,
         CASE WHEN max(py.yr) OVER (PARTITION BY py.o_custkey) = 2001 THEN 'Y' ELSE 'N' END AS CurrentEnrollment,
         py.OrderStatus, py.n_orders
  FROM (SELECT o_custkey, year(o_orderdate) AS yr, max(o_orderstatus) AS OrderStatus, count(*) AS n_orders
        FROM orders GROUP BY ALL) py
  LEFT JOIN customer c ON py.o_custkey = c.c_custkey
"""

CALENDAR = """
  SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS SchoolYearNumberFall,
         make_date(CAST(year(o_orderdate) AS INTEGER), 8, 1) AS FirstDayOfSchoolYear
  FROM orders
"""

PROFILE = f"""
  SELECT e.*, cal.FirstDayOfSchoolYear, g.n_grad, s.sat_n, s.sat_math_score, s.sat_verbal_score,
         s.sat_math_values, i.n_illuminate, m.n_milestone, r.n_rit
  FROM ({ENROL}) e
  LEFT JOIN ({CALENDAR}) cal USING (SchoolYearNumberFall)
  FULL OUTER JOIN (SELECT CAST(o_custkey AS VARCHAR) AS k, CAST(year(o_orderdate) AS VARCHAR) AS y,
                          count(*) AS n_grad FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL) g
       ON e.mask_studentpersonkey IS NOT DISTINCT FROM g.k AND e.SchoolYearNumberFall IS NOT DISTINCT FROM g.y
  FULL OUTER JOIN (SELECT mask_studentpersonkey AS k, SchoolYearFall AS y, count(*) AS sat_n,
                          arg_max(MathScore, struct_pack(d := TestingDateId, o := o_orderkey)) AS sat_math_score,
                          arg_max(VerbalScore, struct_pack(d := TestingDateId, o := o_orderkey)) AS sat_verbal_score,
                          string_agg(CAST(CAST(MathScore AS BIGINT) AS VARCHAR), ',' ORDER BY TestingDateId, o_orderkey)
                              AS sat_math_values
                   FROM ({SAT}) x GROUP BY ALL) s
       ON e.mask_studentpersonkey IS NOT DISTINCT FROM s.k AND e.SchoolYearNumberFall IS NOT DISTINCT FROM s.y
  FULL OUTER JOIN (SELECT mask_studentpersonkey AS k, SchoolYearFall AS y, count(*) AS n_illuminate
                   FROM ({ITEMS}) x GROUP BY ALL) i
       ON e.mask_studentpersonkey IS NOT DISTINCT FROM i.k AND e.SchoolYearNumberFall IS NOT DISTINCT FROM i.y
  FULL OUTER JOIN (SELECT mask_studentpersonkey AS k, SchoolYearFall AS y, count(*) AS n_milestone
                   FROM ({ITEMS}) x WHERE l_extendedprice >= 50000 GROUP BY ALL) m
       ON e.mask_studentpersonkey IS NOT DISTINCT FROM m.k AND e.SchoolYearNumberFall IS NOT DISTINCT FROM m.y
  FULL OUTER JOIN (SELECT CAST(user_id AS VARCHAR) AS k, CAST(1994 + week(ts) AS VARCHAR) AS y, count(*) AS n_rit
                   FROM events GROUP BY ALL) r
       ON e.mask_studentpersonkey IS NOT DISTINCT FROM r.k AND e.SchoolYearNumberFall IS NOT DISTINCT FROM r.y
  WHERE cal.FirstDayOfSchoolYear < DATE '2026-01-01'
"""

ERRORS = """
  SELECT *, actual_sat_math_score - pred_sat_math_score AS error_math,
         abs(actual_sat_math_score - pred_sat_math_score) AS abs_error_math,
         actual_sat_verbal_score - pred_sat_verbal_score AS error_verbal,
         abs(actual_sat_verbal_score - pred_sat_verbal_score) AS abs_error_verbal,
         concat_ws('+', CASE WHEN has_rit THEN 'RIT' END, CASE WHEN has_illuminate THEN 'ILL' END,
                   CASE WHEN has_milestone THEN 'MS' END) AS seg0
  FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice,
               l_extendedprice / CAST(100.0 AS DOUBLE) AS actual_sat_math_score,
               round_even(l_quantity * CAST(15.0 AS DOUBLE), 0) AS pred_sat_math_score,
               l_extendedprice * (CAST(1.0 AS DOUBLE) - l_discount) / CAST(100.0 AS DOUBLE) AS actual_sat_verbal_score,
               round_even(l_quantity * CAST(14.0 AS DOUBLE), 0) AS pred_sat_verbal_score,
               l_returnflag = 'R' AS has_rit, l_linestatus = 'O' AS has_illuminate, l_returnflag = 'N' AS has_milestone
        FROM lineitem) b
"""
