"""Repair of missing or wrong stop ids in hourly rail ridership.

The ridership table is the large side. Everything keyed by stop name, route
and direction is reduced to distinct keys first (bounded by the stop
network, not by the number of ridership rows), the two match attempts are
merged into a single lookup, and the ridership rows meet it in one left
join. Adaptive execution broadcasts the lookup when its measured size is
under the threshold and otherwise falls back to a shuffle join with skew
splitting; no ridership row is dropped or duplicated (default mode).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.functions.rule_table import match_rules
from pickwise.functions.rules import Rule, first_match
from pickwise.plans.materialize import materialize

KEY = ["stop_name", "route", "dir"]

# Override rules, in priority order (first match wins). Each
# gives a fixed stop code to which the direction letter is appended.
_Q_N = ("Q_0_N..N63R_3999",)
_M_96 = ("M..N96St", "M..S96St")
OVERRIDE_RULES = [
    Rule("R36", ("36 St",), route_names=_Q_N),
    Rule("R41", ("59 St",), route_names=_Q_N),
    Rule("N02", ("8 Av",), route_names=_Q_N),
    Rule("N03", ("Fort Hamilton Pkwy",), route_names=_Q_N),
    Rule("N04", ("New Utrecht Av",), route_names=_Q_N),
    Rule("N05", ("18 Av",), route_names=_Q_N),
    Rule("N06", ("20 Av",), route_names=_Q_N),
    Rule("N07", ("Bay Pkwy",), route_names=_Q_N),
    Rule("N08", ("Kings Hwy",), route_names=_Q_N),
    Rule("N09", ("Avenue U",), route_names=_Q_N),
    Rule("N10", ("86 St",), route_names=_Q_N, milepost=1.0822099447250366),
    Rule("Q04", ("86 St",), route_names=_Q_N, milepost=17.645967483520508),
    Rule("Q04", ("86 St (2 Av)",), routes=("Q",)),
    Rule("Q05", ("96 St",), route_names=_M_96),
    Rule("Q04", ("86 St",), route_names=_M_96),
    Rule("Q03", ("72 St",), route_names=_M_96),
    Rule("B08", ("Lexington Av/63 St",), route_names=_M_96),
    Rule("B10", ("57 St/7 Av",), route_names=_M_96),
    Rule("B10", ("57 St",), route_names=("M_0__377430", "M_1__377451")),
    Rule("G21", ("Queens Plaza",), routes=("F", "FX")),
    Rule("F09", ("Court Sq-23 St",), routes=("F", "FX")),
    Rule("F11", ("Lexington Av/53 St",), routes=("F", "FX")),
    Rule("F12", ("5 Av/53 St",), routes=("F", "FX")),
    Rule("D25", ("7 Av (Brighton)",), routes=("B",)),
    Rule("Q04", ("86 St (2 Av)",), routes=("R", "N")),
    Rule("R36", ("36 St (4 Av)",), routes=("R",)),
    Rule("G20", ("36 St (Queens Blvd)",), routes=("R",)),
    Rule("208", ("Gun Hill Rd (White Plains Rd)",), routes=("2", "5")),
    Rule("211", ("Pelham Pkwy (White Plains Rd)",), routes=("2", "5")),
    Rule("503", ("Gun Hill Rd (Dyre Av)",), routes=("2", "5")),
    Rule("504", ("Pelham Pkwy (Dyre Av)",), routes=("2", "5")),
]

# Stop renames for failed matches, in priority order.
RENAME_RULES = [
    Rule("Broadway Junction", ("Broadway Jct",)),
    Rule("Aqueduct-N Conduit Av", ("Aqueduct-North Conduit Av",)),
    Rule("Briarwood", ("Briarwood-Van Wyck Blvd",)),
    Rule("Christopher St-Stonewall", ("Christopher St-Sheridan Sq",)),
    Rule("Franklin Av-Medgar Evers College", ("Franklin Av",), routes=("2", "3", "4", "5")),
    Rule("Hoyt-Schermerhorn Sts", ("Hoyt-Schermerhorn",)),
    Rule("Whitehall St-South Ferry", ("Whitehall St",)),
    Rule("Kosciuszko St", ("Kosciusko St",)),
    Rule("WTC Cortlandt", ("World Trade Center",), routes=("1",)),
    Rule("Park Place", ("Park Pl",), routes=("2", "3")),
    Rule("President St-Medgar Evers College", ("President St",)),
    Rule("Newkirk Av-Little Haiti", ("Newkirk Av",), routes=("2", "5")),
    Rule("Newkirk Plaza", ("Newkirk Av",), routes=("B", "Q")),
    Rule("Ocean Pkwy", ("Ocean Pky",)),
    Rule("South Ferry", ("South Ferry Terminal",)),
    Rule("39 Av-Dutch Kills", ("39 Av",)),
    Rule("14 St-Union Sq", ("Union Sq-14 St", "14 St - Union Sq")),
    Rule("Times Sq-42 St", ("Times Sq - 42 St",)),
    Rule("Beverley Rd", ("Beverly Rd",), routes=("Q",)),
    Rule("4 Av-9 St", ("9 St", "4 Av")),
    Rule("8 St-NYU", ("8 St - NYU",)),
    Rule("168 St-Washington Hts", ("168 St",), routes=("1",)),
    Rule("34 St-Hudson Yards", ("34 St",), routes=("7",)),
    Rule("East 105 St", ("E 105 St",)),
    Rule("Atlantic Av-Barclays Ctr", ("Atlantic Av",), routes=("Q",)),
    Rule("75 St-Elderts Ln", ("75 St",)),
    Rule("34 St-Herald Sq", ("34 St - Herald Sq",)),
    Rule("Delancey St-Essex St", ("Essex St", "Delancey St")),
    Rule("36 St", ("36 St (Queens Blvd)",), routes_not=("R",)),
    Rule("36 St", ("36 St (4 Av)",), routes_not=("R",)),
    Rule("57 St-7 Av", ("57 St - 7 Av", "57 St/7 Av"), routes_not=("M",)),
    Rule("7 Av", ("7 AV(53 St)", "7 Av (53 St)")),
    Rule("Queensboro Plaza", ("Queensboro Plaza (Express)", "Queensboro Plaza (Local)"), routes=("7",)),
    Rule("61 St-Woodside", ("61 St-Woodside (Express)", "61 St-Woodside (Local)"), routes=("7",)),
]

# Reference period of the original job (parameters, not constants of the method).
DEFAULT_YEAR, DEFAULT_MONTHS = "2024", ("10",)


def ridership_overrides(ridership: DataFrame, rules=OVERRIDE_RULES, literal: bool = False,
                        milepost_tol: float = 0.0) -> DataFrame:
    """Apply the override rules to ``gtfsid`` and drop bad runs (id '0').

    Default keeps rows whose id is null (they are what the later steps
    repair); ``literal=True`` uses ``gtfsid <> '0'``, which also drops them.
    """
    fixed = first_match(rules, lambda r: F.concat(F.lit(r.value), F.col("dir")), F.col("gtfsid"), milepost_tol)
    keep = (F.col("gtfsid") != "0") if literal else (F.col("gtfsid").isNull() | (F.col("gtfsid") != "0"))
    return ridership.where(keep).withColumn("gtfsid", fixed)


def override_by_table(ridership: DataFrame, rules: DataFrame, literal: bool = False, tolerance: float = 0.0) -> DataFrame:
    """C48 with rules from a table (``functions.rule_table``) of any size, mileposts
    within a tolerance: the columns and rows of ``ridership_overrides``."""
    keep = (F.col("gtfsid") != "0") if literal else (F.col("gtfsid").isNull() | (F.col("gtfsid") != "0"))
    found = match_rules(ridership.where(keep), rules, tolerance)
    value = F.when(F.col("rule_value").isNotNull(), F.concat("rule_value", "dir")).otherwise(F.col("gtfsid"))
    return found.withColumn("gtfsid", value).drop("rule_value")


def reference_ids(precleaned: DataFrame, year: str = DEFAULT_YEAR, months=DEFAULT_MONTHS,
                  literal: bool = False) -> DataFrame:
    """Known ids of the reference period, per (stop_name, route, dir).

    Default keeps one id per key (the smallest) so later joins cannot
    multiply rows; ``literal=True`` keeps every row.
    """
    good = precleaned.where((F.col("run_year") == year) & F.col("run_month").isin(*months)
                            & F.col("gtfsid").isNotNull()).select("gtfsid", *KEY)
    if literal:
        return good
    # A minimum over text sorts its input, so equal ids are counted by hash first. The optimizer
    # would drop a plain distinct below a minimum; a count that is used stays.
    ids = good.groupBy(*KEY, "gtfsid").agg(F.count(F.lit(1)).alias("n"))
    return ids.groupBy(*KEY).agg(F.min("gtfsid").alias("gtfsid"), F.sum("n").alias("n")).where("n > 0").drop("n")


def missing_ids(precleaned: DataFrame) -> DataFrame:
    """Distinct (stop_name, route, dir) that have rows without an id."""
    return precleaned.where(F.col("gtfsid").isNull()).select(*KEY).distinct()


def match_ids(missing: DataFrame, good: DataFrame) -> DataFrame:
    """First attempt -- exact match on stop name, route and direction."""
    return missing.join(good.withColumnRenamed("gtfsid", "matched_gtfsid"), KEY, "left")


def rename_stops(mismatches: DataFrame, rules=RENAME_RULES, extra_rules: DataFrame | None = None) -> DataFrame:
    """``fixed_stop_name`` for failed matches.

    The fixed rules come first; ``extra_rules`` (priority, stop_name,
    routes_in, routes_not_in, new_name) is a rule table joined on stop name,
    lowest priority winning, for names no fixed rule covers.
    """
    fixed = first_match(rules, lambda r: F.lit(r.value))
    out = mismatches.select("route", "stop_name", "dir").withColumn("_fixed", fixed)
    if extra_rules is not None:
        r = extra_rules.select("priority", F.col("stop_name").alias("_sn"), "routes_in", "routes_not_in", "new_name")
        ok_in = F.col("routes_in").isNull() | F.array_contains("routes_in", F.col("route"))
        ok_out = F.col("routes_not_in").isNull() | ~F.array_contains("routes_not_in", F.col("route"))
        cand = (out.select(*KEY).distinct()
                .join(r, F.col("stop_name") == F.col("_sn"))
                .where(ok_in & ok_out)
                .groupBy(*KEY).agg(F.min_by("new_name", "priority").alias("_extra")))
        out = out.join(cand, KEY, "left")
    else:
        out = out.withColumn("_extra", F.lit(None).cast("string"))
    return (out.withColumn("fixed_stop_name", F.coalesce("_fixed", "_extra", "stop_name"))
            .drop("_fixed", "_extra"))


def match_renamed_ids(renamed: DataFrame, good: DataFrame) -> DataFrame:
    """Second attempt on (route, fixed name, dir)."""
    g = good.select(F.col("route").alias("_r"), F.col("stop_name").alias("_s"), F.col("dir").alias("_d"), "gtfsid")
    cond = (F.col("route") == F.col("_r")) & (F.col("fixed_stop_name") == F.col("_s")) & (F.col("dir") == F.col("_d"))
    return renamed.join(g, cond, "left").drop("_r", "_s", "_d").distinct()


def _lookup_one_pass(precleaned: DataFrame, year: str, months, rename_rules,
                     extra_rename_rules: DataFrame | None) -> DataFrame:
    """Default mode: one pass over the ridership rows gives, per key, the
    reference id (smallest) and whether any row lacks an id; the exact match
    of a missing key is then its own group's reference id -- no join. Rows of
    equal ids are folded by hash first: a minimum over text sorts its input,
    which is then the distinct ids, not the rows. The per-key table is stored,
    so its three uses do not each re-read the ridership rows."""
    in_ref = (F.col("run_year") == year) & F.col("run_month").isin(*months) & F.col("gtfsid").isNotNull()
    ids = (precleaned.groupBy(*KEY, F.when(in_ref, F.col("gtfsid")).alias("ref_id"))
           .agg(F.max(F.col("gtfsid").isNull()).alias("has_missing")))
    keys = materialize(ids.groupBy(*KEY).agg(F.min("ref_id").alias("ref_id"), F.max("has_missing").alias("has_missing")))
    complete = F.col("stop_name").isNotNull() & F.col("route").isNotNull() & F.col("dir").isNotNull()
    good = keys.where(F.col("ref_id").isNotNull() & complete).select(*KEY, F.col("ref_id").alias("gtfsid"))
    attempt = (keys.where(F.col("has_missing") & complete)
               .select(*KEY, F.col("ref_id").alias("matched_gtfsid")))
    renamed = rename_stops(attempt.where(F.col("matched_gtfsid").isNull()), rename_rules, extra_rename_rules)
    second = match_renamed_ids(renamed, good).select(*KEY, F.col("gtfsid").alias("renamed_gtfsid"))
    return attempt.join(second, KEY, "left")


def id_lookup(precleaned: DataFrame, year: str = DEFAULT_YEAR, months=DEFAULT_MONTHS, literal: bool = False,
              rename_rules=RENAME_RULES, extra_rename_rules: DataFrame | None = None) -> DataFrame:
    """Both match attempts as one table keyed by (stop_name, route, dir):
    ``matched_gtfsid`` (exact) and ``renamed_gtfsid`` (after renaming).

    Its size is bounded by the distinct keys of the stop network, not by the
    number of ridership rows (default mode: one row per key).
    """
    if not literal:
        return _lookup_one_pass(precleaned, year, months, rename_rules, extra_rename_rules)
    good = reference_ids(precleaned, year, months, literal)
    attempt = match_ids(missing_ids(precleaned), good)
    renamed = rename_stops(attempt.where(F.col("matched_gtfsid").isNull()), rename_rules, extra_rename_rules)
    second = match_renamed_ids(renamed, good).select(*KEY, F.col("gtfsid").alias("renamed_gtfsid"))
    return attempt.join(second, KEY, "left")


def fill_ids(ridership: DataFrame, year: str = DEFAULT_YEAR, months=DEFAULT_MONTHS, literal: bool = False,
             override_rules=OVERRIDE_RULES, rename_rules=RENAME_RULES,
             extra_rename_rules: DataFrame | None = None, milepost_tol: float = 0.0) -> DataFrame:
    """Every (kept) ridership row with ``final_gtfsid`` =
    coalesce(own id after overrides, exact match, match after renaming).

    The lookup is stored first (a job), so that the planner knows its size in
    bytes: a small one is broadcast and the ridership rows are never shuffled,
    a large one meets them in a shuffle join.
    """
    pre = ridership_overrides(ridership, override_rules, literal, milepost_tol)
    lookup = materialize(id_lookup(pre, year, months, literal, rename_rules, extra_rename_rules))
    return (pre.join(lookup, KEY, "left")
            .withColumn("final_gtfsid", F.coalesce("gtfsid", "matched_gtfsid", "renamed_gtfsid"))
            .select(*pre.columns, "final_gtfsid"))
