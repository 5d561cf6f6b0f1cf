"""Ordered rule lists compiled to first-match CASE expressions (PF16).

Rules are data: a list of ``Rule``s in priority order becomes one searched
CASE (``F.when`` chain), evaluated inside whole-stage codegen. A rule whose
route test meets a null route does not match (three-valued logic).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    value: str
    stop_names: tuple[str, ...]
    route_names: tuple[str, ...] = ()
    routes: tuple[str, ...] = ()
    routes_not: tuple[str, ...] = ()
    milepost: float | None = None


def rule_condition(r: Rule, milepost_tol: float = 0.0) -> Column:
    cond = F.col("stop_name").isin(*r.stop_names)
    if r.route_names:
        cond = cond & F.col("route_name").isin(*r.route_names)
    if r.routes:
        cond = cond & F.col("route").isin(*r.routes)
    if r.routes_not:
        cond = cond & ~F.col("route").isin(*r.routes_not)
    if r.milepost is not None:
        m = F.col("milepost")
        cond = cond & ((m == F.lit(r.milepost)) if milepost_tol == 0 else (F.abs(m - F.lit(r.milepost)) <= milepost_tol))
    return cond


def first_match(rules, value_of, default: Column | None = None, milepost_tol: float = 0.0) -> Column:
    """CASE WHEN rule_1 THEN value_of(rule_1) ... ELSE default END.

    Every rule tests ``stop_name``, so the chain is guarded by one hash-set
    membership test on all rule names: rows no rule can match (nearly all)
    skip the chain.
    """
    names = sorted({n for r in rules for n in r.stop_names})
    expr = None
    for r in rules:
        c = rule_condition(r, milepost_tol)
        v = value_of(r)
        expr = F.when(c, v) if expr is None else expr.when(c, v)
    if expr is None:
        return default if default is not None else F.lit(None)
    chain = expr.otherwise(default) if default is not None else expr
    guarded = F.when(F.col("stop_name").isin(*names), chain)
    return guarded.otherwise(default) if default is not None else guarded
