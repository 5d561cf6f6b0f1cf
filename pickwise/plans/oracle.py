"""Independent SQL oracles (DuckDB dialect) for the registered queries.

``FIXTURE_SQL`` rebuilds the star -> GTFS mapping of
``pickwise.sources.star_fixture`` as CTEs over the driver's views; each
oracle appends its own CTEs and final SELECT. Floats are rounded with
``sbround`` (Spark's ``bround`` semantics) exactly where the Spark query
uses ``bround``.
"""

from __future__ import annotations

# Stop id overrides, first match wins. Stop name, stop code,
# route names (any of), routes (any of), milepost; None is any.
OVERRIDES = [
    ("36 St", "R36", ["Q_0_N..N63R_3999"], None, None),
    ("59 St", "R41", ["Q_0_N..N63R_3999"], None, None),
    ("8 Av", "N02", ["Q_0_N..N63R_3999"], None, None),
    ("Fort Hamilton Pkwy", "N03", ["Q_0_N..N63R_3999"], None, None),
    ("New Utrecht Av", "N04", ["Q_0_N..N63R_3999"], None, None),
    ("18 Av", "N05", ["Q_0_N..N63R_3999"], None, None),
    ("20 Av", "N06", ["Q_0_N..N63R_3999"], None, None),
    ("Bay Pkwy", "N07", ["Q_0_N..N63R_3999"], None, None),
    ("Kings Hwy", "N08", ["Q_0_N..N63R_3999"], None, None),
    ("Avenue U", "N09", ["Q_0_N..N63R_3999"], None, None),
    ("86 St", "N10", ["Q_0_N..N63R_3999"], None, 1.0822099447250366),
    ("86 St", "Q04", ["Q_0_N..N63R_3999"], None, 17.645967483520508),
    ("86 St (2 Av)", "Q04", None, ["Q"], None),
    ("96 St", "Q05", ["M..N96St", "M..S96St"], None, None),
    ("86 St", "Q04", ["M..N96St", "M..S96St"], None, None),
    ("72 St", "Q03", ["M..N96St", "M..S96St"], None, None),
    ("Lexington Av/63 St", "B08", ["M..N96St", "M..S96St"], None, None),
    ("57 St/7 Av", "B10", ["M..N96St", "M..S96St"], None, None),
    ("57 St", "B10", ["M_0__377430", "M_1__377451"], None, None),
    ("Queens Plaza", "G21", None, ["F", "FX"], None),
    ("Court Sq-23 St", "F09", None, ["F", "FX"], None),
    ("Lexington Av/53 St", "F11", None, ["F", "FX"], None),
    ("5 Av/53 St", "F12", None, ["F", "FX"], None),
    ("7 Av (Brighton)", "D25", None, ["B"], None),
    ("86 St (2 Av)", "Q04", None, ["R", "N"], None),
    ("36 St (4 Av)", "R36", None, ["R"], None),
    ("36 St (Queens Blvd)", "G20", None, ["R"], None),
    ("Gun Hill Rd (White Plains Rd)", "208", None, ["2", "5"], None),
    ("Pelham Pkwy (White Plains Rd)", "211", None, ["2", "5"], None),
    ("Gun Hill Rd (Dyre Av)", "503", None, ["2", "5"], None),
    ("Pelham Pkwy (Dyre Av)", "504", None, ["2", "5"], None),
]

# Stop renames. Old name, new name, routes (any of), route it
# doesn't apply to; None is any.
RENAMES = [
    ("Broadway Jct", "Broadway Junction", None, None),
    ("Aqueduct-North Conduit Av", "Aqueduct-N Conduit Av", None, None),
    ("Briarwood-Van Wyck Blvd", "Briarwood", None, None),
    ("Christopher St-Sheridan Sq", "Christopher St-Stonewall", None, None),
    ("Franklin Av", "Franklin Av-Medgar Evers College", ["2", "3", "4", "5"], None),
    ("Hoyt-Schermerhorn", "Hoyt-Schermerhorn Sts", None, None),
    ("Whitehall St", "Whitehall St-South Ferry", None, None),
    ("Kosciusko St", "Kosciuszko St", None, None),
    ("World Trade Center", "WTC Cortlandt", ["1"], None),
    ("Park Pl", "Park Place", ["2", "3"], None),
    ("President St", "President St-Medgar Evers College", None, None),
    ("Newkirk Av", "Newkirk Av-Little Haiti", ["2", "5"], None),
    ("Newkirk Av", "Newkirk Plaza", ["B", "Q"], None),
    ("Ocean Pky", "Ocean Pkwy", None, None),
    ("South Ferry Terminal", "South Ferry", None, None),
    ("39 Av", "39 Av-Dutch Kills", None, None),
    ("Union Sq-14 St", "14 St-Union Sq", None, None),
    ("14 St - Union Sq", "14 St-Union Sq", None, None),
    ("Times Sq - 42 St", "Times Sq-42 St", None, None),
    ("Beverly Rd", "Beverley Rd", ["Q"], None),
    ("9 St", "4 Av-9 St", None, None),
    ("4 Av", "4 Av-9 St", None, None),
    ("8 St - NYU", "8 St-NYU", None, None),
    ("168 St", "168 St-Washington Hts", ["1"], None),
    ("34 St", "34 St-Hudson Yards", ["7"], None),
    ("E 105 St", "East 105 St", None, None),
    ("Atlantic Av", "Atlantic Av-Barclays Ctr", ["Q"], None),
    ("75 St", "75 St-Elderts Ln", None, None),
    ("34 St - Herald Sq", "34 St-Herald Sq", None, None),
    ("Essex St", "Delancey St-Essex St", None, None),
    ("Delancey St", "Delancey St-Essex St", None, None),
    ("36 St (Queens Blvd)", "36 St", None, "R"),
    ("36 St (4 Av)", "36 St", None, "R"),
    ("57 St - 7 Av", "57 St-7 Av", None, "M"),
    ("57 St/7 Av", "57 St-7 Av", None, "M"),
    ("7 AV(53 St)", "7 Av", None, None),
    ("7 Av (53 St)", "7 Av", None, None),
    ("Queensboro Plaza (Express)", "Queensboro Plaza", ["7"], None),
    ("Queensboro Plaza (Local)", "Queensboro Plaza", ["7"], None),
    ("61 St-Woodside (Express)", "61 St-Woodside", ["7"], None),
    ("61 St-Woodside (Local)", "61 St-Woodside", ["7"], None),
]


def _sql(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, list):
        return "[" + ", ".join(map(_sql, v)) + "]"
    return f"CAST({v!r} AS DOUBLE)" if isinstance(v, float) else "'" + v.replace("'", "''") + "'"


def _values(rows) -> str:
    return ",\n    ".join("(" + ", ".join([str(n), *map(_sql, r)]) + ")" for n, r in enumerate(rows))


RULES_SQL = f"""
override_rules AS (SELECT * FROM (VALUES
    {_values(OVERRIDES)}) v(n, stop, code, route_names, routes, milepost)),
rename_rules AS (SELECT * FROM (VALUES
    {_values(RENAMES)}) v(n, stop, new_name, routes, not_route)),
rule_cases AS (
  SELECT row_number() OVER (ORDER BY kind, n) - 1 AS j, * FROM (
    SELECT 0 AS kind, n, stop, CAST(NULL AS VARCHAR) AS new_name, route_names[1] AS route_name, routes[1] AS route, milepost FROM override_rules
    UNION ALL SELECT 1, n, stop, new_name, NULL, routes[1], NULL FROM rename_rules)
),"""

FIXTURE_SQL = "WITH" + RULES_SQL + """
base AS (
  SELECT o.o_orderkey AS ok, o.o_custkey AS ck, c.c_nationkey AS nk, n.n_name,
         o.o_orderdate, o.o_orderpriority,
         CASE WHEN o.o_orderkey % 2 = 0 THEN 'pick_a' ELSE 'pick_b' END AS bundle,
         (o.o_orderkey // 2) % 2 AS direction_id,
         CASE WHEN o.o_orderkey % 97 = 5 THEN CAST(9 AS BIGINT) ELSE o.o_custkey % 3 END AS pat
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
trips AS (
  SELECT bundle, 'R' || CAST(nk AS VARCHAR) AS route_id, 'T' || CAST(ok AS VARCHAR) AS trip_id,
         'S' || substr(o_orderpriority, 1, 1) AS service_id,
         CASE WHEN pat = 2 AND nk % 2 = 0 THEN n_name || ' LTD' ELSE n_name END AS trip_headsign,
         direction_id, 'B' || CAST(ck AS VARCHAR) AS block_id,
         CASE WHEN ok % 211 = 0 THEN NULL
              ELSE 'R' || CAST(nk AS VARCHAR) || '_' || CAST(direction_id AS VARCHAR) || '_' || CAST(pat AS VARCHAR) END AS shape_id
  FROM base
  WHERE NOT ((bundle = 'pick_b' AND nk = 24) OR (bundle = 'pick_a' AND nk = 23))
),
lines AS (
  SELECT l.*, b.*,
         (CASE WHEN b.nk % 4 = 1 THEN 420 + (b.ok * 7) % 110 ELSE (b.ok * 37) % 1560 END)
           + (l.seq - 1) * (5 + b.ok % 4) AS arr_min,
         (b.ck // 100) * 100 + (b.nk * 4 + l.seq * (1 + b.pat) + CASE WHEN b.bundle = 'pick_b' AND b.nk % 5 = 0 THEN 1 ELSE 0 END) % 100 AS stop_key
  FROM (SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                                  l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) AS seq
        FROM lineitem) l
  JOIN base b ON l.l_orderkey = b.ok
),
clocks AS (
  SELECT *, (CASE WHEN arr_min // 60 < 10 THEN '0' || CAST(arr_min // 60 AS VARCHAR) ELSE CAST(arr_min // 60 AS VARCHAR) END)
            || ':' ||
            (CASE WHEN arr_min % 60 < 10 THEN '0' || CAST(arr_min % 60 AS VARCHAR) ELSE CAST(arr_min % 60 AS VARCHAR) END)
            || ':00' AS clock
  FROM lines
),
stop_times AS (
  SELECT bundle, 'T' || CAST(ok AS VARCHAR) AS trip_id,
         'ST' || lpad(CAST(stop_key AS VARCHAR), 9, '0') AS stop_id,
         CASE WHEN seq = 1 AND ok % 89 = 0 THEN NULL ELSE clock END AS arrival_time,
         clock AS departure_time,
         CASE WHEN seq = 1 THEN 1 ELSE 0 END AS timepoint,
         CAST(seq AS INTEGER) AS stop_sequence, 0 AS pickup_type, 0 AS drop_off_type
  FROM clocks
),
stop_parts AS (SELECT p_partkey, p_name FROM part),
picks AS (SELECT 'pick_a' AS bundle UNION ALL SELECT 'pick_b'),
stops AS (
  SELECT pk.bundle, 'ST' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS stop_id, p_name AS stop_name,
         CASE WHEN p_partkey = 98 THEN NULL ELSE CAST(40.5 AS DOUBLE) + (p_partkey * 37 % 100) / 250 END AS stop_lat,
         CAST(-74.2 AS DOUBLE) + (p_partkey * 61 % 100) / 200 AS stop_lon
  FROM stop_parts CROSS JOIN picks pk
),
shape_reference AS (
  SELECT pk.bundle, r.stop_id, r.revenue_stop FROM (
    SELECT 'ST' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS stop_id, CAST(p_partkey % 2 AS INTEGER) AS revenue_stop
    FROM stop_parts WHERE p_partkey % 7 <> 0
    UNION ALL
    SELECT 'ST' || lpad(CAST(p_partkey AS VARCHAR), 9, '0'), 1
    FROM stop_parts WHERE p_partkey % 7 <> 0 AND p_partkey % 10 = 0) r CROSS JOIN picks pk
),
calendar AS (
  SELECT bundle, service_id,
         CASE WHEN service_id IN ('S1', 'S2', 'S5') THEN 1 ELSE 0 END AS monday,
         CASE WHEN service_id IN ('S1', 'S2', 'S5') THEN 1 ELSE 0 END AS tuesday,
         CASE WHEN service_id IN ('S1', 'S2', 'S5') THEN 1 ELSE 0 END AS wednesday,
         CASE WHEN service_id IN ('S1', 'S2', 'S5') THEN 1 ELSE 0 END AS thursday,
         CASE WHEN service_id IN ('S1', 'S5') THEN 1 ELSE 0 END AS friday,
         CASE WHEN service_id IN ('S3', 'S5') THEN 1 ELSE 0 END AS saturday,
         CASE WHEN service_id IN ('S4', 'S5') THEN 1 ELSE 0 END AS sunday,
         CASE WHEN bundle = 'pick_a' THEN 19960105 ELSE 20000101 END AS start_date,
         CASE WHEN bundle = 'pick_a' THEN 19960231 ELSE 20000331 END AS end_date
  FROM (SELECT DISTINCT bundle, service_id FROM trips) s
),
bundle_dates AS (
  SELECT CASE WHEN year(service_date) = 1996 THEN 'pick_a' ELSE 'pick_b' END AS bundle, service_date,
         year(service_date) AS pick_year, 'Winter' AS pick_name, 'scheduled' AS sched_type, false AS manual
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS service_date FROM base) d
  WHERE month(service_date) BETWEEN 1 AND 3 AND year(service_date) IN (1996, 2000)
),
calendar_dates AS (
  SELECT bundle, CASE WHEN day(service_date) % 9 = 4 THEN 'S1' ELSE 'S3' END AS service_id,
         CAST(year(service_date) * 10000 + month(service_date) * 100 + day(service_date) AS INTEGER) AS date,
         CASE WHEN day(service_date) % 9 = 4 THEN 2 ELSE 1 END AS exception_type
  FROM bundle_dates WHERE day(service_date) % 9 IN (4, 7)
),
routes AS (
  SELECT t.bundle, t.route_id, 'AG' || CAST(n.nk % 3 AS VARCHAR) AS agency_id,
         t.route_id AS route_short_name, n.n_name AS route_long_name
  FROM (SELECT DISTINCT bundle, route_id FROM trips) t
  JOIN (SELECT DISTINCT 'R' || CAST(nk AS VARCHAR) AS route_id, nk, n_name FROM base) n ON t.route_id = n.route_id
  WHERE n.nk <> 22
),
met AS (
  SELECT l.*, c.* EXCLUDE (j, n, kind), 'ST' || lpad(CAST(l.stop_key AS VARCHAR), 9, '0') AS sid,
         CASE WHEN l.direction_id = 0 THEN 'N' ELSE 'S' END AS dir, 'R' || CAST(l.nk AS VARCHAR) AS base_route,
         CAST(year(l.l_shipdate) AS VARCHAR) AS run_year, CAST(month(l.l_shipdate) AS VARCHAR) AS run_month,
         year(l.l_shipdate) = 2000 AND month(l.l_shipdate) >= 9 AS in_ref
  FROM lines l LEFT JOIN rule_cases c
    ON l.ok % 5 = 0 AND c.j = (l.ok // 5) % (SELECT count(*) FROM rule_cases)
),
ridership AS (
  SELECT CASE WHEN ok % 13 = 0 THEN '0'
              WHEN NOT in_ref AND (ok % 7 = 0 OR new_name IS NOT NULL) THEN NULL
              ELSE sid || dir END AS gtfsid,
         'RUN' || run_year || '-' || run_month AS ridership_run_id, run_year, run_month,
         CASE WHEN isodow(l_shipdate) >= 6 THEN 1 ELSE 0 END AS weekend,
         (arr_min // 60) % 24 AS hour,
         coalesce(route_name, base_route || '..' || dir) AS route_name,
         coalesce(route, base_route) AS route, dir,
         CASE WHEN stop IS NULL THEN coalesce(p_name, sid) || CASE WHEN NOT in_ref AND (ok + seq) % 11 = 0 THEN ' (Local)' ELSE '' END
              WHEN in_ref THEN coalesce(new_name, stop) ELSE stop END AS stop_name,
         base_route || ':' || sid AS lookup,
         coalesce(milepost, seq * CAST(1.5 AS DOUBLE)) AS milepost,
         l_quantity AS ons, l_discount AS offs, l_extendedprice AS volume, l_tax AS md_trips,
         l_quantity AS capacity, l_discount AS vc
  FROM met LEFT JOIN stop_parts ON stop_key = p_partkey
),
fixture_rename_rules AS (
  SELECT DISTINCT 1000 AS priority, p_name || ' (Local)' AS stop_name, p_name AS new_name FROM stop_parts
)
"""


def sbround(expr: str, digits: int) -> str:
    """Half-even rounding of a double's shortest decimal form -- what Spark's
    ``bround`` does (DuckDB's ``round_even`` rounds the binary value, so it
    disagrees on near-ties such as 0.9812500000000001)."""
    return f"CAST(round_even(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


def with_fixture(*ctes: str, select: str) -> str:
    """Fixture CTEs, then the given ``name AS (...)`` CTEs, then ``select``."""
    extra = "".join(f",\n{c.strip()}" for c in ctes)
    return FIXTURE_SQL.rstrip() + extra + "\n" + select.strip()
