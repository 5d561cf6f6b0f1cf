"""Rule tables: first match wins, tolerances, nulls, bands, against brute force."""

import math
import random

from pickwise.functions import rule_table as R
from pickwise.functions.rules import Rule, first_match
from pyspark.sql import functions as F

rng = random.Random(4)
ROWS = "id int, stop_name string, route_name string, route string, milepost double"


def brute(row, rules, tolerance):
    _, name, route_name, route, post = row
    met = []
    for priority, names, route_names, routes, routes_not, at, tol, value in rules:
        tol = tolerance if tol is None else tol
        if (value is not None and name is not None and name in (names or [])
                and (route_names is None or route_name is not None and route_name in route_names)
                and (routes is None or route is not None and route in routes)
                and (routes_not is None or not routes_not or route is not None and route not in routes_not)
                and (at is None or post is not None and not math.isnan(post) and not math.isnan(at) and tol >= 0 and abs(post - at) <= tol)):
            met.append((priority, value))
    return min(met)[1] if met else None


def maybe(x, share=0.3):
    return None if rng.random() < share else x


def test_matches_brute_force(spark):
    names, routes = [f"s{i}" for i in range(6)], [f"r{i}" for i in range(4)]
    post = lambda: rng.choice([round(rng.uniform(-3, 9), 2), 0.0, 1.5, -0.75])
    rules = [(rng.randint(0, 40), maybe(rng.sample(names, rng.randint(0, 2)), 0.05), maybe([rng.choice(routes)], 0.7), maybe(rng.sample(routes, 2), 0.6), maybe(rng.sample(routes, rng.randint(1, 2)), 0.7),
              maybe(post(), 0.3), maybe(rng.choice([0.0, 0.1, 0.75, 2.0, -1.0]), 0.4), maybe(f"v{i % 30}", 0.05)) for i in range(300)]
    rules += [(0, ["s0"], None, None, None, float("nan"), 1.0, "nan"), (0, ["s0", "s0", None], ["r0"], None, None, None, None, "twice")]
    rows = [(i, maybe(rng.choice(names), 0.05), maybe(rng.choice(routes)), maybe(rng.choice(routes)), maybe(post(), 0.1)) for i in range(800)]
    rows += [(900, "s0", "r0", "r0", float("nan")), (901, "s0", None, None, 1e300), (902, "s0", None, None, float("-inf"))]
    df = spark.createDataFrame(rows, ROWS)
    for tolerance in (0.0, 0.25):
        got = {r.id: r.rule_value for r in R.match_rules(df, spark.createDataFrame(rules, R.RULES), tolerance).collect()}
        assert got == {row[0]: brute(row, rules, tolerance) for row in rows}
    assert sum(v is not None for v in got.values()) > 300


def test_edges(spark):
    df = spark.createDataFrame([(1, "a", None, "x", 1.5), (1, "a", None, "x", 1.5), (2, None, None, None, None)], ROWS)
    none = spark.createDataFrame([], R.RULES)
    assert [r.rule_value for r in R.match_rules(df, none).collect()] == [None] * 3
    assert R.match_rules(df.limit(0), none).count() == 0
    one = spark.createDataFrame([(1, ["a"], None, None, None, 1.0, 0.5, "edge")], R.RULES)
    assert sorted(str(r.rule_value) for r in R.match_rules(df, one).collect()) == ["None", "edge", "edge"]


def test_a_rule_list_as_table_gives_the_case_expression(spark):
    rules = [Rule("A", ("s1", "s2"), routes=("r1",)), Rule("B", ("s1",), routes_not=("r2",)), Rule("C", ("s1",), milepost=2.0), Rule("D", ("s3",), route_names=("n1",))]
    rows = [(i, f"s{i % 4}", maybe(f"n{i % 2}"), maybe(f"r{i % 3}"), maybe(float(i % 5))) for i in range(200)]
    df = spark.createDataFrame(rows, ROWS)
    want = df.withColumn("rule_value", first_match(rules, lambda r: F.lit(r.value))).collect()
    assert sorted(map(tuple, R.match_rules(df, R.rule_table(spark, rules)).collect()), key=str) == sorted(map(tuple, want), key=str)


def test_a_busy_stop_meets_only_rules_near_its_milepost(spark):
    rules = spark.range(3000).select(F.col("id").alias("priority"), F.array(F.lit("hub")).alias("stop_names"), *[F.lit(None).cast("array<string>").alias(c) for c in ("route_names", "routes", "routes_not")],
                                     (F.col("id") * 1.0).alias("milepost"), F.lit(0.1).alias("tolerance"), F.concat(F.lit("v"), "id").alias("value"))
    df = spark.range(3000).select(F.lit("hub").alias("stop_name"), F.lit("n").alias("route_name"), F.lit("r").alias("route"), (F.col("id") + 0.05).alias("milepost"))
    out = R.match_rules(df, rules)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "band" in plan
    assert out.where("rule_value = concat('v', cast(floor(milepost) as string))").count() == 3000


def test_rules_that_ask_the_same_are_folded_before_they_meet_keys(spark):
    """10,000 rules ask two different things of one stop; the first of each, at equal priorities the smallest value, is met, and rows aren't shuffled."""
    i = F.col("id")
    rules = spark.range(10000).select(((i * 7919) % 5000).alias("priority"), F.array(F.lit("hub")).alias("stop_names"), F.lit(None).cast("array<string>").alias("route_names"),
                                      F.when(i % 2 == 0, F.array(F.lit("r1"), F.lit("r0"))).otherwise(F.array(F.lit("r0"), F.lit("r1"), F.lit("r0"))).alias("routes"), F.lit(None).cast("array<string>").alias("routes_not"),
                                      F.when(i % 3 == 0, F.lit(1.0)).alias("milepost"), F.lit(None).cast("double").alias("tolerance"), F.concat(F.lit("v"), i).alias("value"))
    df = spark.range(400).select(F.lit("hub").alias("stop_name"), F.lit("n").alias("route_name"), F.concat(F.lit("r"), i % 3).alias("route"), (i % 2 + 1.0).alias("milepost"))
    made = [r.asDict() for r in rules.collect()]
    least = [min((r["priority"], r["value"]) for r in made if r["milepost"] in ats)[1] for ats in ((None,), (None, 1.0))]
    out = R.match_rules(df, rules)
    assert {tuple(r) for r in out.select("route", "milepost", "rule_value").distinct().collect()} == {
        *((f"r{k}", 2.0, least[0]) for k in (0, 1)), *((f"r{k}", 1.0, least[1]) for k in (0, 1)), ("r2", 1.0, None), ("r2", 2.0, None)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan  # rules are folded to the first of each test
    assert "BroadcastHashJoin [coalesce" in plan and "SortMergeJoin [coalesce" not in plan
