"""Independent DuckDB SQL for each registered query (same column names).

Written directly against the base tables (joins first, then plain GROUP BY), not
mirroring the Spark plans, so it checks results rather than re-running them.
DuckDB types are cast to the Spark result types (BIGINT sums, INTEGER years).
"""

from __future__ import annotations

from policypanel.plans import roles as R


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


_UNITS = _in(R.UNITS)
_T = R.TREATED
_LO, _HI = R.DID_WINDOW
_ELO, _EHI = R.EVENT_WINDOW


def _did_sql(extra_where: str, cut: int, pre_years: int, post_years: int, lo: int, hi: int,
             outcome: str = "count(*)", digits: int = 9) -> str:
    return f"""
WITH ev AS (
  SELECT n.n_name AS unit, year(o.o_orderdate) AS yr,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS price
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE n.n_name IN ({_UNITS}) AND year(o.o_orderdate) BETWEEN {lo} AND {hi} {extra_where}),
ue AS (
  SELECT unit, CASE WHEN yr >= {cut} THEN 1 ELSE 0 END AS post, {outcome} AS events
  FROM ev GROUP BY 1, 2),
t AS (
  SELECT unit, post,
         CAST(events AS DOUBLE) / CAST(CASE WHEN post = 0 THEN {pre_years} ELSE {post_years} END AS DOUBLE) AS v
  FROM ue),
l AS (
  SELECT max(CASE WHEN unit = '{_T}' AND post = 0 THEN v END) AS treated_pre,
         max(CASE WHEN unit = '{_T}' AND post = 1 THEN v END) AS treated_post,
         avg(CASE WHEN unit <> '{_T}' AND post = 0 THEN v END) AS control_pre,
         avg(CASE WHEN unit <> '{_T}' AND post = 1 THEN v END) AS control_post
  FROM t)
SELECT round(treated_pre, {digits}) AS treated_pre, round(treated_post, {digits}) AS treated_post,
       round(control_pre, {digits}) AS control_pre, round(control_post, {digits}) AS control_post,
       round(treated_post - treated_pre, {digits}) AS treated_change,
       round(control_post - control_pre, {digits}) AS control_change,
       round((treated_post - treated_pre) - (control_post - control_pre), {digits}) AS did_estimate,
       round((treated_post - treated_pre) / treated_pre * 100, {digits}) AS treated_pct_change,
       round((control_post - control_pre) / control_pre * 100, {digits}) AS control_pct_change
FROM l"""


_SUB = f"AND o.o_orderpriority = '{R.SUBGROUP_PRIORITY}'"
_PD0, _PD1 = R.PLACEBO_DIVISORS[0], R.PLACEBO_DIVISORS[1]
_D0, _D1 = R.DID_DIVISORS[0], R.DID_DIVISORS[1]

# Prepared event log over lineitem (the original's analysis frame).
_EV = f"""ev AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(year(l_shipdate) AS INTEGER) AS year,
         strftime(l_shipdate, '%Y-%m') AS month,
         CASE WHEN year(l_shipdate) >= {R.EVENT_CUT} THEN 'post' ELSE 'pre' END AS era,
         CAST(l_quantity AS INTEGER) AS persons_injured,
         CASE WHEN l_linestatus = '{R.FATAL_STATUS}' THEN 1 ELSE 0 END AS persons_killed,
         CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS INTEGER) ELSE 0 END AS ped_injured,
         CASE WHEN l_returnflag = 'A' AND l_linestatus = '{R.FATAL_STATUS}' THEN 1 ELSE 0 END AS ped_killed,
         CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS INTEGER) ELSE 0 END AS cyc_injured,
         CASE WHEN l_returnflag = 'N' AND l_linestatus = '{R.FATAL_STATUS}' THEN 1 ELSE 0 END AS cyc_killed,
         CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INTEGER) ELSE 0 END AS mot_injured,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = '{R.FATAL_STATUS}' THEN 1 ELSE 0 END AS mot_killed
  FROM lineitem
  WHERE l_shipdate IS NOT NULL AND year(l_shipdate) BETWEEN {_ELO} AND {_EHI}),
yrs AS (SELECT era, count(DISTINCT year) AS years_in_era FROM ev GROUP BY era)"""


def _b(x: str) -> str:
    return f"CAST(sum({x}) AS BIGINT)"


def _py(x: str) -> str:
    return f"CAST({x} AS DOUBLE) / CAST(years_in_era AS DOUBLE)"


SQL: dict[str, str] = {}

SQL["did_total"] = _did_sql("", R.DID_CUT, _D0, _D1, _LO, _HI)
SQL["did_subgroup"] = _did_sql(_SUB, R.DID_CUT, _D0, _D1, _LO, _HI)
SQL["did_placebo"] = _did_sql("", R.PLACEBO_CUT, _PD0, _PD1, _LO, R.DID_CUT - 1)
SQL["did_total_sum"] = _did_sql("", R.DID_CUT, _D0, _D1, _LO, _HI, "sum(price)", 4)
SQL["did_subgroup_sum"] = _did_sql(_SUB, R.DID_CUT, _D0, _D1, _LO, _HI, "sum(price)", 4)
SQL["did_placebo_sum"] = _did_sql("", R.PLACEBO_CUT, _PD0, _PD1, _LO, R.DID_CUT - 1, "sum(price)", 4)
SQL["unit_era"] = f"""
WITH ev AS (
  SELECT n.n_name AS unit, CASE WHEN year(o.o_orderdate) >= {R.DID_CUT} THEN 1 ELSE 0 END AS post,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS price
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE n.n_name IN ({_UNITS}) AND year(o.o_orderdate) BETWEEN {_LO} AND {_HI})
SELECT unit, post AS "POST", CAST(sum(price) AS DOUBLE) AS fatalities, count(*) AS crashes,
       round(CAST(sum(price) AS DOUBLE) / CASE WHEN post = 0 THEN {_D0} ELSE {_D1} END, 4) AS fatalities_per_year
FROM ev GROUP BY unit, post"""
SQL["did_summary"] = f"""
SELECT 'real_total' AS analysis, did_estimate AS did_estimate_per_year FROM ({SQL['did_total']}) a
UNION ALL
SELECT 'real_subgroup', did_estimate FROM ({SQL['did_subgroup']}) b
UNION ALL
SELECT 'placebo_total', did_estimate FROM ({SQL['did_placebo']}) c"""

SQL["unit_year_panel"] = f"""
SELECT n.n_name AS unit, CAST(year(o.o_orderdate) AS INTEGER) AS year,
       CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_fatalities,
       count(*) AS num_crashes
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE n.n_name IN ({_UNITS}) AND year(o.o_orderdate) BETWEEN {_LO} AND {_HI}
GROUP BY 1, 2 ORDER BY 1, 2"""

_codes = " OR ".join(f"(n.n_regionkey = {r} AND n.n_nationkey = {k})" for (r, k) in R.UNIT_CODES)
SQL["did_flags"] = f"""
SELECT o.o_orderkey, n.n_name AS unit, CAST(year(o.o_orderdate) AS INTEGER) AS year,
       CASE WHEN n.n_name = '{_T}' THEN 1 ELSE 0 END AS "TREATMENT",
       CASE WHEN year(o.o_orderdate) >= {R.DID_CUT} THEN 1 ELSE 0 END AS "POST",
       CASE WHEN n.n_name = '{_T}' AND year(o.o_orderdate) >= {R.DID_CUT} THEN 1 ELSE 0 END AS "TREAT_POST"
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE {_codes}"""

# every year from the first on
_EV_OPEN = _EV.replace(f"BETWEEN {_ELO} AND {_EHI}", f">= {_ELO}")

SQL["annual_summary"] = f"""
WITH {_EV_OPEN}
SELECT year, count(*) AS crashes, {_b('persons_killed')} AS persons_killed,
       {_b('persons_injured')} AS persons_injured, {_b('ped_killed')} AS ped_killed,
       {_b('cyc_killed')} AS cyc_killed, {_b('mot_killed')} AS mot_killed
FROM ev GROUP BY year ORDER BY year"""

SQL["pre_post_summary"] = f"""
WITH {_EV},
a AS (
  SELECT era, count(*) AS crashes_total, {_b('persons_killed')} AS killed_total,
         {_b('persons_injured')} AS injured_total, {_b('ped_killed')} AS ped_killed_total,
         {_b('cyc_killed')} AS cyc_killed_total, {_b('mot_killed')} AS mot_killed_total
  FROM ev GROUP BY era)
SELECT a.*, y.years_in_era,
       {_py('crashes_total')} AS crashes_per_year, {_py('killed_total')} AS killed_per_year,
       {_py('injured_total')} AS injured_per_year, {_py('ped_killed_total')} AS ped_killed_per_year,
       {_py('cyc_killed_total')} AS cyc_killed_per_year, {_py('mot_killed_total')} AS mot_killed_per_year
FROM a JOIN yrs y USING (era) ORDER BY era"""

_CATS = ["ped_injured", "ped_killed", "cyc_injured", "cyc_killed", "mot_injured", "mot_killed"]
SQL["category_pre_post"] = f"""
WITH {_EV},
a AS (SELECT era, {', '.join(f"{_b(c)} AS {c}" for c in _CATS)} FROM ev GROUP BY era)
SELECT a.*, y.years_in_era, {', '.join(f"{_py(c)} AS {c}_per_year" for c in _CATS)}
FROM a JOIN yrs y USING (era) ORDER BY era"""

SQL["segment_pre_post"] = f"""
WITH {_EV},
pop AS (
  SELECT n.n_name AS segment, count(*) AS population
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1),
seg AS (
  SELECT upper(trim(n.n_name)) AS segment, ev.*
  FROM ev JOIN supplier s ON ev.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  WHERE n.n_name IS NOT NULL AND trim(n.n_name) <> ''),
a AS (
  SELECT segment, era, count(*) AS crashes, {_b('persons_killed')} AS killed,
         {_b('persons_injured')} AS injured
  FROM seg GROUP BY 1, 2),
b AS (
  SELECT a.*, y.years_in_era, {_py('crashes')} AS crashes_per_year,
         {_py('killed')} AS killed_per_year, {_py('injured')} AS injured_per_year
  FROM a JOIN yrs y USING (era))
SELECT b.*, pop.population,
       killed_per_year * CAST(100000 AS DOUBLE) / CAST(pop.population AS DOUBLE) AS killed_per_100k_per_year,
       injured_per_year * CAST(100000 AS DOUBLE) / CAST(pop.population AS DOUBLE) AS injured_per_100k_per_year
FROM b LEFT JOIN pop USING (segment) ORDER BY segment, era"""

SQL["topk_shift"] = f"""
WITH {_EV},
f AS (
  SELECT upper(trim(p.p_brand)) AS factor, ev.era, ev.persons_killed
  FROM ev JOIN part p ON ev.l_partkey = p.p_partkey
  WHERE p.p_brand IS NOT NULL),
g AS (
  SELECT factor, era, count(*) AS crashes, {_b('persons_killed')} AS killed
  FROM f WHERE factor <> '' AND factor <> 'UNSPECIFIED' GROUP BY 1, 2),
h AS (SELECT g.*, y.years_in_era, {_py('crashes')} AS crashes_per_year FROM g JOIN yrs y USING (era)),
top AS (
  SELECT factor FROM h WHERE era = 'post'
  ORDER BY crashes_per_year DESC, factor ASC LIMIT {R.TOP_K})
SELECT h.* FROM h WHERE factor IN (SELECT factor FROM top) ORDER BY factor, era"""

def _hostile_label(key: str, label: str) -> str:
    return (f"CASE WHEN {key} % 10 = 0 THEN NULL WHEN {key} % 9 = 0 THEN '  ' WHEN {key} % 8 = 0 THEN ' unspecified' "
            f"WHEN {key} % 3 = 0 THEN lower({label}) || ' ' ELSE {label} END")


# A whole year without keys counts in the years per era alone; some keys are unknown.
_KNOWN = f"ev.year <> {R.EVENT_CUT - 1} AND ev.l_orderkey % 6 <> 0"
SQL["segment_pre_post_hostile"] = SQL["segment_pre_post"].replace(
    "SELECT upper(trim(n.n_name)) AS segment, ev.*", f"SELECT upper(trim({_hostile_label('s.s_suppkey', 'n.n_name')})) AS segment, ev.*").replace(
    "WHERE n.n_name IS NOT NULL AND trim(n.n_name) <> '')", f"WHERE {_KNOWN} AND coalesce(trim({_hostile_label('s.s_suppkey', 'n.n_name')}), '') <> '')")
SQL["topk_shift_hostile"] = SQL["topk_shift"].replace(
    "SELECT upper(trim(p.p_brand)) AS factor", f"SELECT upper(trim({_hostile_label('p.p_partkey', 'p.p_brand')})) AS factor").replace(
    "WHERE p.p_brand IS NOT NULL)", f"WHERE {_KNOWN} AND ({_hostile_label('p.p_partkey', 'p.p_brand')}) IS NOT NULL)")

_WINDOW = f" AND year(l_shipdate) BETWEEN {_ELO} AND {_EHI}"
SQL["monthly_series"] = f"""
WITH {_EV.replace(_WINDOW, '')}
SELECT month, count(*) AS crashes, {_b('persons_killed')} AS killed,
       {_b('persons_injured')} AS injured
FROM ev GROUP BY month ORDER BY month"""

_ALO, _AHI = R.ANOMALY_WINDOW
SQL["window_rate"] = f"""
WITH {_EV},
a AS (
  SELECT year, count(*) AS crashes, {_b('persons_killed')} AS killed,
         {_b('persons_injured')} AS injured
  FROM ev WHERE year BETWEEN {_ALO} AND {_AHI} GROUP BY year)
SELECT a.*, CAST(killed AS DOUBLE) * CAST(1000 AS DOUBLE) / CAST(crashes AS DOUBLE)
       AS fatality_rate_per_1k_crashes
FROM a ORDER BY year"""

_tokens = _in(t.upper() for t in R.UNSPECIFIED_TOKENS)
SQL["missing_share"] = f"""
WITH o AS (
  SELECT upper(trim(n.n_name)) AS segment,
         CASE WHEN o.o_orderpriority IS NULL OR upper(trim(o.o_orderpriority)) = ''
                OR upper(trim(o.o_orderpriority)) IN ({_tokens}) THEN 1 ELSE 0 END AS miss
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE n.n_name IS NOT NULL AND trim(n.n_name) <> '')
SELECT segment, count(*) AS total, {_b('miss')} AS unspecified,
       CAST(sum(miss) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS unspecified_share
FROM o GROUP BY segment ORDER BY unspecified_share DESC, segment"""

SQL["pre_post_change"] = f"""
WITH {_EV_OPEN},
a AS (SELECT year, {_b('ped_killed')} AS ped_killed, {_b('persons_killed')} AS persons_killed
      FROM ev GROUP BY year),
m AS (
  SELECT 'ped_killed' AS measure,
         avg(CASE WHEN year < {R.EVENT_CUT} THEN CAST(ped_killed AS DOUBLE) END) AS pre_mean,
         avg(CASE WHEN year >= {R.EVENT_CUT} THEN CAST(ped_killed AS DOUBLE) END) AS post_mean
  FROM a
  UNION ALL
  SELECT 'persons_killed',
         avg(CASE WHEN year < {R.EVENT_CUT} THEN CAST(persons_killed AS DOUBLE) END),
         avg(CASE WHEN year >= {R.EVENT_CUT} THEN CAST(persons_killed AS DOUBLE) END)
  FROM a)
SELECT measure, pre_mean, post_mean, (pre_mean - post_mean) / pre_mean * 100 AS pct_drop FROM m"""


# -- cleaning, sources and sinks ------------------------------------------------------

def _dbl(x) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _range_case(col: str, spec: dict) -> str:
    x = f"abs({col})" if spec.get("absolute") else col
    bad = []
    if spec.get("lo") is not None:
        bad.append(f"{x} < {_dbl(spec['lo'])}")
    if spec.get("hi") is not None:
        bad.append(f"{x} > {_dbl(spec['hi'])}")
    if spec.get("zero_is_missing"):
        bad.append(f"{col} = 0")
    return f"CASE WHEN {' OR '.join(bad)} THEN NULL ELSE {col} END AS {col}"


def _sentinel_case(col: str, values) -> str:
    vals = ", ".join(_dbl(v) for v in values)
    return f"CASE WHEN {col} IN ({vals}) THEN NULL ELSE {col} END AS {col}"


_critical = " AND ".join(f"{c} IS NOT NULL" for c in R.PANEL_CRITICAL)
_in_window = f"year(l_shipdate) BETWEEN {_ELO} AND {_EHI}"
_panel_cols = []
for _c in ["l_quantity", "l_discount", "l_tax"]:
    if _c in R.PANEL_SENTINELS:
        _panel_cols.append(_sentinel_case(_c, R.PANEL_SENTINELS[_c]))
    elif _c in R.PANEL_RANGES:
        _panel_cols.append(_range_case(_c, R.PANEL_RANGES[_c]))
    else:
        _panel_cols.append(_c)

SQL["panel_clean"] = f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
       {', '.join(_panel_cols)}, l_returnflag, l_linestatus
FROM lineitem
WHERE {_in_window} AND {_critical}"""

_FATAL = f"CASE WHEN l_linestatus = '{R.FATAL_STATUS}' THEN 1 ELSE 0 END"
SQL["events_clean"] = f"""
SELECT strftime(l_shipdate, '%m/%d/%Y') AS ship_date,
       upper(trim(l_returnflag)) AS return_flag,
       l_linestatus AS line_status,
       CAST(l_suppkey AS VARCHAR) AS supplier,
       coalesce(CAST(l_quantity AS INTEGER), 0) AS quantity,
       {_FATAL} AS fatal
FROM lineitem
WHERE l_shipdate IS NOT NULL AND l_returnflag IS NOT NULL
  AND upper(trim(l_returnflag)) NOT IN ('', 'NULL', '0')"""

SQL["events_prepare"] = f"""
SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS event_date,
       CAST(year(l_shipdate) AS INTEGER) AS year, strftime(l_shipdate, '%Y-%m') AS month,
       CASE WHEN year(l_shipdate) >= {R.EVENT_CUT} THEN 'post' ELSE 'pre' END AS era,
       coalesce(CAST(l_quantity AS INTEGER), 0) AS quantity, {_FATAL} AS fatal
FROM lineitem
WHERE l_shipdate IS NOT NULL AND year(l_shipdate) >= {_ELO}"""

# The hostile cells of plans/facts.py, in SQL.
_HOSTILE = f"""h AS (
  SELECT l_orderkey, l_linenumber, l_shipdate,
         CASE WHEN l_orderkey % 17 = 0 THEN NULL WHEN l_orderkey % 19 = 0 THEN '  '
              WHEN l_orderkey % 23 = 0 THEN 'not a date' WHEN l_orderkey % 29 = 0 THEN '02/30/1996'
              ELSE strftime(l_shipdate, '%m/%d/%Y') END AS ship,
         l_orderkey % 17 <> 0 AND l_orderkey % 19 <> 0 AND l_orderkey % 23 <> 0 AND l_orderkey % 29 <> 0 AS real_day,
         CASE WHEN l_orderkey % 31 = 0 THEN NULL WHEN l_orderkey % 37 = 0 THEN ' ' WHEN l_orderkey % 11 = 0 THEN ' null'
              WHEN l_orderkey % 13 = 0 THEN '0 ' WHEN l_orderkey % 7 = 0 THEN ' ' || lower(l_returnflag) || ' '
              ELSE l_returnflag END AS seg,
         l_linestatus, CAST(l_suppkey AS VARCHAR) AS supplier,
         CASE WHEN l_orderkey % 5 = 0 THEN 0 ELSE coalesce(CAST(l_quantity AS INTEGER), 0) END AS quantity,
         CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE {_FATAL} END AS fatal
  FROM lineitem)"""
_HOSTILE_KEPT = "ship IS NOT NULL AND trim(ship) <> '' AND seg IS NOT NULL AND upper(trim(seg)) NOT IN ('', 'NULL', '0')"
SQL["events_clean_hostile"] = f"""
WITH {_HOSTILE}
SELECT ship AS ship_date, upper(trim(seg)) AS return_flag, l_linestatus AS line_status, supplier, quantity, fatal
FROM h WHERE {_HOSTILE_KEPT}"""
SQL["events_wide"] = f"""
WITH {_HOSTILE}
SELECT ship AS ship_date, CASE WHEN real_day THEN strftime(l_shipdate, '%Y-%m-%d') END AS ship_date_formatted,
       seg AS return_flag, upper(trim(seg)) AS return_flag_clean, l_linestatus AS line_status, supplier,
       quantity AS quantity_clean, fatal AS fatal_clean, CASE WHEN quantity > 0 THEN 1 ELSE 0 END AS injury_occurred
FROM h WHERE {_HOSTILE_KEPT}"""
SQL["events_prepare_hostile"] = f"""
WITH {_HOSTILE}
SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS event_date,
       CAST(year(l_shipdate) AS INTEGER) AS year, strftime(l_shipdate, '%Y-%m') AS month,
       CASE WHEN year(l_shipdate) >= {R.EVENT_CUT} THEN 'post' ELSE 'pre' END AS era, quantity, fatal
FROM h WHERE real_day AND l_shipdate IS NOT NULL AND year(l_shipdate) >= {_ELO + 1}"""
SQL["panel_clean_hostile"] = f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS year,
       CASE WHEN l_orderkey % 5 <> 0 THEN CAST(month(l_shipdate) AS INTEGER) END AS month,
       {', '.join(_panel_cols)}, l_returnflag, l_linestatus
FROM lineitem
WHERE {_in_window} AND {_critical} AND l_orderkey % 7 <> 0 AND l_orderkey % 11 <> 0 AND l_orderkey % 13 <> 0
  AND l_orderkey % 17 <> 0"""
SQL["panel_date_flag"] = f"""
WITH p AS (
  SELECT l_orderkey, l_linenumber, l_shipdate,
         CASE WHEN l_orderkey % 17 <> 0 THEN CAST(year(l_shipdate) AS INTEGER) END AS year,
         CASE WHEN l_orderkey % 5 <> 0 THEN CAST(month(l_shipdate) AS INTEGER) END AS month FROM lineitem)
SELECT l_orderkey, l_linenumber, year, month,
       CASE WHEN year IS NOT NULL AND month IS NOT NULL THEN strftime(make_date(year, month, l_linenumber), '%Y-%m-%d') END AS crash_date,
       CASE WHEN year >= {R.EVENT_CUT} THEN 1 ELSE 0 END AS post
FROM p"""
SQL["table_artefact_scan"] = SQL["panel_clean"]

SQL["date_from_parts"] = """
WITH p AS (
  SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS y,
         CAST(month(l_shipdate) AS INTEGER) AS m,
         CAST(day(l_shipdate) + l_linenumber AS INTEGER) AS d
  FROM lineitem)
SELECT l_orderkey, l_linenumber, y, m, d,
       CASE WHEN y IS NOT NULL AND m IS NOT NULL
                 AND d BETWEEN 1 AND day(last_day(make_date(y, m, 1)))
            THEN strftime(make_date(y, m, d), '%Y-%m-%d') END AS event_date
FROM p"""

SQL["yearly_union"] = f"""
SELECT l_orderkey AS "ORDERKEY", l_linenumber AS "LINENUMBER",
       CAST(year(l_shipdate) AS INTEGER) AS "YEAR", CAST(month(l_shipdate) AS INTEGER) AS "MONTH",
       l_quantity AS "QUANTITY", l_discount AS "DISCOUNT", l_tax AS "TAX",
       l_returnflag AS "RETURNFLAG"
FROM lineitem WHERE l_shipdate IS NOT NULL"""

SQL["csv_permissive"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
       TRY_CAST(o_orderpriority AS DOUBLE) AS o_orderpriority
FROM orders"""

_DIRTY = """d AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate AS day,
         CASE WHEN o_orderkey % 7 = 0 THEN 'C' ELSE '' END || o_custkey AS c,
         CASE WHEN o_orderkey % 11 = 0 THEN '1996-02-31' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS t,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'high' ELSE '1' END AS p
  FROM orders),
l AS (SELECT *, o_orderkey || ',' || c || ',' || o_orderstatus || ',' || t || ',' || coalesce(p, '') AS line FROM d)"""
SQL["csv_rejects"] = f"""
WITH {_DIRTY}
SELECT true AS file_known, 'o_custkey' AS "column", c AS value, line FROM l WHERE o_orderkey % 7 = 0
UNION ALL SELECT true, 'o_orderdate', t, line FROM l WHERE o_orderkey % 11 = 0
UNION ALL SELECT true, 'o_shippriority', p, line FROM l WHERE p = 'high'"""
SQL["csv_good_rows"] = f"""
WITH {_DIRTY}
SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus, t AS o_orderdate,
       CAST(p AS INTEGER) AS o_shippriority
FROM l WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 AND coalesce(p, '') <> 'high'"""

SQL["csv_ctrl_a_roundtrip"] = SQL["events_clean"]
SQL["table_register_scan"] = SQL["events_clean"]
SQL["catalog_check"] = f"""
WITH e AS ({SQL['events_clean']})
SELECT 'columns' AS item, (SELECT count(*) FROM (DESCRIBE SELECT * FROM e)) AS value
UNION ALL SELECT 'rows', count(*) FROM e
UNION ALL SELECT 'sample_rows', least(count(*), 5) FROM e"""
SQL["csv_single_part"] = SQL["annual_summary"]
SQL["csv_parts_verify"] = f"""
SELECT count(*) AS rows_written, count(*) AS rows_read, true AS matches
FROM ({SQL['panel_clean']}) p"""

SQL["write_audit"] = f"""
WITH p AS ({SQL['panel_clean']}),
counts AS (SELECT count(*) AS n, count(*) - count(l_quantity) AS q, count(*) - count(l_discount) AS dis,
           count(*) - count(l_tax) AS tax FROM p)
SELECT 'raw' AS item, count(*) AS value FROM lineitem
UNION ALL SELECT 'year_window', count(*) FROM lineitem WHERE {_in_window}
UNION ALL SELECT 'critical_not_null', count(*) FROM lineitem WHERE {_in_window} AND {_critical}
UNION ALL SELECT 'nulls l_quantity', q FROM counts UNION ALL SELECT 'nulls l_discount', dis FROM counts
UNION ALL SELECT 'nulls l_tax', tax FROM counts
UNION ALL SELECT 'written', n FROM counts UNION ALL SELECT 'read back', n FROM counts"""
SQL["table_publish"] = SQL["events_clean"]
SQL["table_keep"] = f"SELECT * FROM ({SQL['events_clean']}) e WHERE fatal = 1"

_codes_values = ", ".join(f"({r}, {k}, '{u}')" for (r, k), u in R.UNIT_CODES.items())
SQL["inline_dim"] = f"""
WITH codes(n_regionkey, n_nationkey, unit) AS (VALUES {_codes_values}),
cust AS (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY 1)
SELECT codes.unit, n.n_name, coalesce(cust.customers, 0) AS customers
FROM nation n
JOIN codes ON n.n_regionkey = codes.n_regionkey AND n.n_nationkey = codes.n_nationkey
LEFT JOIN cust ON n.n_nationkey = cust.c_nationkey"""


# -- profiling ---------------------------------------------------------------------------

def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


SQL["row_audit"] = _union([
    "SELECT 0 AS step, 'raw' AS stage, count(*) AS rows FROM lineitem",
    f"SELECT 1, 'year_window', count(*) FROM lineitem WHERE {_in_window}",
    f"SELECT 2, 'critical_not_null', count(*) FROM lineitem WHERE {_in_window} AND {_critical}",
])

SQL["value_counts"] = _union([
    f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS count
FROM orders GROUP BY {c}""" for c in ["o_orderstatus", "o_orderpriority"]])

SQL["distinct_listing"] = "SELECT DISTINCT p_brand FROM part ORDER BY p_brand NULLS FIRST LIMIT 30"

SQL["quantile_1000"] = _union([
    f"""SELECT '{c}' AS "column", count({c}) AS rows, TRUE AS within_error FROM lineitem"""
    for c in ["l_quantity", "l_discount", "l_tax"]])

_EXACT = [(c, q) for c in ["l_extendedprice", "l_partkey", "l_quantity", "l_discount", "l_tax"]
          for q in [0.01, 0.25, 0.5, 0.75, 0.99]]
SQL["exact_quantiles"] = _union([
    f"""SELECT '{c}' AS "column", CAST({q} AS DOUBLE) AS q, count({c}) AS rows,
       CAST(quantile_disc({c}, {q}) AS DOUBLE) AS value FROM lineitem""" for c, q in _EXACT])

_ERAS = {"pre": f"BETWEEN {_ELO} AND {R.EVENT_CUT - 1}", "post": f"BETWEEN {R.EVENT_CUT} AND {_EHI}",
         "all": f"BETWEEN {_ELO} AND {_EHI}"}
SQL["quantile_windows"] = _union([
    f"""SELECT '{w}' AS "window", '{c}' AS "column", count({c}) AS rows, CAST({q} AS DOUBLE) AS q,
       CAST(quantile_disc({c}, {q}) AS DOUBLE) AS value FROM lineitem WHERE year(l_shipdate) {cond}"""
    for w, cond in _ERAS.items() for c in ["l_quantity", "l_discount", "l_tax"] for q in [0.21, 0.51, 0.89]])

SQL["distinct_sets"] = _union([
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE a) AS pre, count(*) FILTER (WHERE b) AS post,
       count(*) FILTER (WHERE a OR b) AS either, count(*) FILTER (WHERE a AND b) AS both,
       count(*) FILTER (WHERE a AND NOT b) AS pre_only, count(*) FILTER (WHERE b AND NOT a) AS post_only
FROM (SELECT {c}, bool_or(coalesce(year(l_shipdate) {_ERAS['pre']}, false)) AS a,
             bool_or(coalesce(year(l_shipdate) {_ERAS['post']}, false)) AS b FROM lineitem GROUP BY {c})"""
    for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"]])

_FREQUENT = ["l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_returnflag"]
SQL["frequent_values"] = _union([
    f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS count FROM lineitem
GROUP BY {c} HAVING count(*) >= CAST(0.015 AS DOUBLE) * (SELECT count(*) FROM lineitem)""" for c in _FREQUENT])
SQL["frequent_modes"] = f"""
WITH f AS ({SQL['frequent_values']}),
names("column") AS (VALUES {', '.join(f"('{c}')" for c in _FREQUENT)}),
r AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value ASC NULLS FIRST) AS place FROM f)
SELECT names."column", r.value AS mode, r.count AS mode_count
FROM names LEFT JOIN r ON r."column" = names."column" AND r.place = 1"""

SQL["key_counts_lexical"] = """
SELECT CAST(c_nationkey AS VARCHAR) AS c_nationkey, count(*) AS count
FROM customer GROUP BY 1 ORDER BY 1"""


def _distinct_with_null(c: str) -> str:
    return f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)"


_LINE_CODES = ["l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax", "l_suppkey"]
SQL["distinct_counts"] = _union([
    f"""SELECT '{c}' AS "column", {_distinct_with_null(c)} AS distinct_values FROM lineitem"""
    for c in _LINE_CODES])

_PANEL_TYPES = [("l_orderkey", False), ("l_partkey", False), ("l_suppkey", False),
                ("l_linenumber", False), ("year", False), ("month", False),
                ("l_quantity", False), ("l_discount", False), ("l_tax", False),
                ("l_returnflag", True), ("l_linestatus", True)]
SQL["null_counts"] = """WITH p AS (
  SELECT *, year(l_shipdate) AS year, month(l_shipdate) AS month FROM lineitem)
""" + _union([
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS nulls,
       count(*) FILTER (WHERE {c} IS NULL {f"OR trim({c}) = ''" if text else ''}) AS null_or_blank
FROM p""" for c, text in _PANEL_TYPES])

SQL["range_stats"] = _union([
    f"""SELECT '{c}' AS "column", CAST(min({c}) AS DOUBLE) AS min_value,
       CAST(max({c}) AS DOUBLE) AS max_value FROM lineitem"""
    for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]])

SQL["length_stats"] = _union([
    f"""SELECT '{c}' AS "column", CAST(min(length({c})) AS INTEGER) AS min_len,
       CAST(max(length({c})) AS INTEGER) AS max_len, avg(length({c})) AS avg_len
FROM documents""" for c in ["text", "lang", "source"]])

_STATS = ["l_quantity", "l_discount", "l_tax"]
SQL["summary_stats"] = _union([
    f"""SELECT * FROM (
  WITH m AS (SELECT CAST({c} AS DOUBLE) AS value, count(*) AS n FROM lineitem GROUP BY 1),
  best AS (SELECT value, n FROM m ORDER BY n DESC, value ASC NULLS FIRST LIMIT 1)
  SELECT '{c}' AS "column", round(avg(CAST({c} AS DOUBLE)), 9) AS mean,
         CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS median,
         (SELECT value FROM best) AS mode, (SELECT n FROM best) AS mode_count,
         round(stddev_samp(CAST({c} AS DOUBLE)), 9) AS stddev
  FROM lineitem)""" for c in _STATS])

SQL["describe_numeric"] = _union([
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 9) AS mean,
       round(stddev_samp(CAST({c} AS DOUBLE)), 9) AS stddev,
       CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max
FROM lineitem""" for c in _STATS])

_PART = [("p_partkey", "num"), ("p_name", "text"), ("p_brand", "text"), ("p_type", "text"),
         ("p_size", "num"), ("p_retailprice", "num")]


def _profile_row(c: str, kind: str) -> str:
    num = kind == "num"
    mn = f"CAST(min({c}) AS DOUBLE)" if num else "CAST(NULL AS DOUBLE)"
    mx = f"CAST(max({c}) AS DOUBLE)" if num else "CAST(NULL AS DOUBLE)"
    ln = f"CAST(min(length({c})) AS DOUBLE)" if not num else "CAST(NULL AS DOUBLE)"
    lx = f"CAST(max(length({c})) AS DOUBLE)" if not num else "CAST(NULL AS DOUBLE)"
    return f"""SELECT '{c}' AS "column", count(*) AS rows,
       count(*) FILTER (WHERE {c} IS NULL) AS nulls, {_distinct_with_null(c)} AS distinct_values,
       {mn} AS min_value, {mx} AS max_value, {ln} AS min_len, {lx} AS max_len
FROM part"""


SQL["profile_all"] = _union([_profile_row(c, k) for c, k in _PART])
