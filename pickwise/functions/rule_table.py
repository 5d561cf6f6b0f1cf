"""Ordered rules as a table: first match wins, mileposts within a tolerance.

The counterpart of ``rules.first_match`` for rules that users keep in a table of
any size. Rows are folded to the distinct things that rules ask about before any
rule meets them. Rules with a milepost meet keys in an equi-join on (stop name,
band): mileposts are cut into bands as wide as the largest tolerance, a rule
stands in each band its interval touches (three at most), so a busy stop with
thousands of rules compares a key with those near its milepost alone. Rules
without one join on the stop name. Of rules that ask the same, only the first can
be met first: they are folded to it before they meet a key, so a join makes no more
rows than keys times different tests. What is found, a row a key, is measured before
rows meet it: while it can be broadcast they aren't shuffled.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pickwise.functions.rules import Rule
from pickwise.plans.materialize import materialize

KEY = ["stop_name", "route_name", "route", "milepost"]
RULES = ("priority long, stop_names array<string>, route_names array<string>, routes array<string>, "
         "routes_not array<string>, milepost double, tolerance double, value string")


def rule_table(spark, rules: list[Rule], tolerance: float | None = None) -> DataFrame:
    """A list of ``Rule``s as a table; priorities are their places."""
    return spark.createDataFrame([(i, [*r.stop_names], [*r.route_names] or None, [*r.routes] or None, [*r.routes_not] or None, r.milepost, tolerance, r.value)
                                  for i, r in enumerate(rules)], RULES)


def _band(milepost: Column, width: float, side: float = 0.0) -> Column:
    return F.floor(milepost / F.lit(width) + F.lit(side)).cast("long")


def _usable(milepost: Column) -> Column:
    """The milepost where it is a number that has a band, else null."""
    return F.when(~F.isnan(milepost) & (F.abs(milepost) < 1e12), milepost)


def _broadcast_bytes(spark) -> int:
    """The session's limit for tables that are broadcast without being asked for."""
    n, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", spark.conf.get("spark.sql.autoBroadcastJoinThreshold").lower()).groups()
    return int(n) << {"k": 10, "m": 20, "g": 30}.get(unit[:1], 0)


def _bytes(df: DataFrame) -> int:
    """About the bytes of the rows of a table in memory. Runs a job."""
    text = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns])
    return df.agg(F.coalesce(F.sum(text + 16 + 16 * len(df.columns)), F.lit(0))).first()[0]


def match_rules(rows: DataFrame, rules: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """``rows`` (with stop_name, route_name, route, milepost) and ``rule_value``:
    the value of the rule of least priority that a row meets, of several at one
    priority the smallest value; null where it meets none.

    ``rules``: the columns of RULES. A rule asks that the stop name is listed in
    ``stop_names`` and, where they aren't null, that the route name is in
    ``route_names``, the route in ``routes`` and not in ``routes_not``, and the
    milepost no more than ``tolerance`` (of the rule, else the argument's) from
    ``milepost``. A null on the row's side of such a test doesn't meet it. Rules
    without names or with a null value or a negative tolerance meet nothing;
    an empty list is met by nothing, an empty ``routes_not`` by every route.
    Rows keep their number. Runs jobs over the rules and the keys of the rows, and
    stores the tests with their least priority and the keys.
    """
    r = rules.select("priority", F.array_distinct("stop_names").alias("stop_names"), "route_names", "routes", "routes_not", "milepost",
                     F.coalesce("tolerance", F.lit(float(tolerance))).alias("within"), "value")
    r = r.where("value is not null and (milepost is null or within >= 0)").withColumn("stop_name", F.explode("stop_names")).drop("stop_names").where("stop_name is not null")
    r = r.withColumn("milepost", F.when(F.col("milepost").isNotNull(), F.coalesce(_usable(F.col("milepost")), F.lit(float("nan"))))).where("milepost is null or not isnan(milepost)")
    lists = [F.array_sort(F.array_distinct(c)).alias(c) for c in ("route_names", "routes", "routes_not")]
    # equal structs have nulls in the same places
    r = r.select(F.struct("stop_name", *lists, "milepost", F.when(F.col("milepost").isNotNull(), F.col("within")).alias("within")).alias("test"), "priority", "value")
    # a minimum of numbers is taken by hash; that of texts sorts, and meets the first rules alone
    first = materialize(r.groupBy("test").agg(F.min("priority").alias("priority")))
    same = F.col("f.test").eqNullSafe(F.col("r.test")) & F.col("f.priority").eqNullSafe(F.col("r.priority"))
    r = r.alias("r").join(first.alias("f"), same, "left_semi").groupBy("test", "priority").agg(F.min("value").alias("value")).select("test.*", "priority", "value")
    placed, free = r.where("milepost is not null"), r.where("milepost is null").drop("milepost", "within")
    width = first.agg(F.max(F.when(F.col("test.within") < 1e12, F.col("test.within")))).first()[0] or 1.0
    keys = materialize(rows.select(*KEY).where("stop_name is not null").distinct())
    low, high = (_band(F.col("milepost") + s * F.least("within", F.lit(width)), width, s * 1e-6) for s in (-1, 1))
    placed = placed.withColumn("band", F.explode(F.sequence(low, high))).withColumnsRenamed({"milepost": "at"})
    near = (keys.withColumn("band", _band(_usable(F.col("milepost")), width)).join(placed, ["stop_name", "band"])
            .where(F.abs(F.col("milepost") - F.col("at")) <= F.col("within")))
    tests = [F.col("route_names").isNull() | F.array_contains("route_names", F.col("route_name")),
             F.col("routes").isNull() | F.array_contains("routes", F.col("route")),
             F.col("routes_not").isNull() | ~F.array_contains("routes_not", F.col("route"))]
    met = reduce(lambda a, b: a & b, tests)
    found = [x.where(met).select(*KEY, "priority", "value") for x in (near, keys.join(free, "stop_name"))]
    best = found[0].unionByName(found[1]).groupBy(*KEY).agg(F.min(F.struct("priority", "value")).alias("rule"))
    named = best.select(*[F.col(c).alias(f"_{c}") for c in KEY], F.col("rule.value").alias("rule_value"))
    if _bytes(named) <= _broadcast_bytes(rows.sparkSession):
        named = F.broadcast(named)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in KEY])
    return rows.join(named, same, "left").drop(*[f"_{c}" for c in KEY])
