"""Measure layer over the star (J0-J17): a registry and ``evaluate``.

A measure is either a *base* aggregate on one table (optionally under a
filter that REPLACES any outer filter on the same column, as a CALCULATE
does) or a *derived* ratio of other measures (blank on division by zero).

``evaluate(tables, measures, by=("dim_channel.channel", ...), where={...})``

* joins only the dimensions a measure needs, following the model's
  relationships (fact_alert -> fact_transaction -> dimensions,
  fact_alert -> dim_risk_rule); filters flow from a dimension to the fact
  and from fact_transaction to fact_alert, never back;
* a grouping attribute a measure cannot reach (e.g. a rule for a
  transaction measure) or one its own filter replaces does not split that
  measure -- the measure's value repeats on each of those rows;
* base measures of one table are conditional aggregates of one scan; the
  (small) results are put together by their grouping keys;
* group combinations where every measure is blank are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Relationships of the model (many side, key, one side, key).
# ---------------------------------------------------------------------------
RELATIONSHIPS = [
    ("fact_transaction", "date_key", "dim_date", "date_key"),
    ("fact_transaction", "time_key", "dim_time", "time_key"),
    ("fact_transaction", "customer_key", "dim_customer", "customer_key"),
    ("fact_transaction", "merchant_key", "dim_merchant", "merchant_key"),
    ("fact_transaction", "channel_key", "dim_channel", "channel_key"),
    ("fact_transaction", "card_key", "dim_card", "card_key"),
    ("fact_alert", "_mirror_row_id", "fact_transaction", "_mirror_row_id"),
    ("fact_alert", "rule_id", "dim_risk_rule", "rule_id"),
]
ANALYST_ALERTS_PER_YEAR = 50000
HOME_CURRENCY = "MYR"


@dataclass(frozen=True)
class Measure:
    """``kind`` (count, sum, avg, distinct) of ``col``, under a filter that replaces any outer filter on ``filter_col``
    ("table.column"); or a value derived from other measures."""
    key: str
    label: str
    table: str | None = None
    kind: str | None = None
    col: str | None = None
    filter_col: str | None = None
    filter: Callable[[], Column] | None = None
    derived: Callable[[dict], Column] | None = None
    deps: tuple = field(default_factory=tuple)

    def agg(self, grouped: bool) -> Column:
        """The aggregate over all rows; its filter is a condition inside, so measures of one table share one scan. A group
        that the filter leaves without rows is blank."""
        value = F.lit(1) if self.col is None else F.col(self.col)
        if self.filter is not None:
            value = F.when(self.filter(), value)
        out = {"count": F.count, "sum": F.sum, "avg": F.avg, "distinct": F.count_distinct}[self.kind](value)
        if self.filter is not None and self.kind in ("count", "distinct") and grouped:
            out = F.when(out > 0, out)
        return out


def _ratio(a, b):
    return lambda m: F.try_divide(m[a].cast("double"), m[b].cast("double"))


FT, FA = "fact_transaction", "fact_alert"
# The measures' names and labels.
MEASURES = {m.key: m for m in [
    Measure("transactions", "Transactions", FT, "count"),
    Measure("total_amount", "Total Amount", FT, "sum", "txn_amount"),
    Measure("distinct_customers", "Distinct Customers", FT, "distinct", "customer_key"),
    Measure("avg_risk_score", "Average Risk Score", FT, "avg", "risk_score"),
    Measure("high_risk_txns", "High Risk Transactions", FT, "count", None, f"{FT}.risk_band", lambda: F.col("risk_band") == "HIGH"),
    Measure("high_risk_rate", "High Risk Rate", derived=_ratio("high_risk_txns", "transactions"), deps=("high_risk_txns", "transactions")),
    Measure("exposure_at_risk", "Exposure at Risk", FT, "sum", "txn_amount", f"{FT}.risk_band", lambda: F.col("risk_band") == "HIGH"),
    Measure("approval_rate", "Approval Rate", derived=_ratio("approved_txns", "decided_txns"), deps=("approved_txns", "decided_txns")),
    Measure("approved_txns", "Approved", FT, "count", None, f"{FT}.auth_approved", lambda: F.col("auth_approved") == F.lit(True)),
    Measure("decided_txns", "Decided", FT, "count", None, f"{FT}.auth_approved", lambda: F.col("auth_approved").isNotNull()),
    Measure("cross_border_amount", "Cross Border Amount", FT, "sum", "txn_amount", f"{FT}.txn_currency", lambda: ~F.col("txn_currency").eqNullSafe(F.lit(HOME_CURRENCY))),
    Measure("alerts_raised", "Alerts Raised", FT, "count", None, f"{FT}.risk_band", lambda: F.col("risk_band") == "HIGH"),
    Measure("alert_rate", "Alert Rate", derived=_ratio("alerts_raised", "transactions"), deps=("alerts_raised", "transactions")),
    Measure("analyst_years", "Analyst Years to Clear", derived=lambda m: m["alerts_raised"].cast("double") / F.lit(float(ANALYST_ALERTS_PER_YEAR)), deps=("alerts_raised",)),
    Measure("rule_firings", "Rule Firings", FA, "count"),
    Measure("firings_per_txn", "Rule Firings per Transaction", derived=_ratio("rule_firings", "transactions"), deps=("rule_firings", "transactions")),
    Measure("txns_with_any_rule", "Transactions With Any Rule", FA, "distinct", "_mirror_row_id"),
    Measure("any_rule_rate", "Any Rule Rate", derived=_ratio("txns_with_any_rule", "transactions"), deps=("txns_with_any_rule", "transactions")),
    Measure("firings_per_alert", "Rule Firings per Alert", derived=_ratio("rule_firings", "alerts_raised"), deps=("rule_firings", "alerts_raised")),
]}
MONEY = ("total_amount", "exposure_at_risk", "cross_border_amount")

# The measures as the model publishes them.
PUBLISHED = ["transactions", "total_amount", "distinct_customers", "avg_risk_score", "high_risk_txns",
             "high_risk_rate", "exposure_at_risk", "approval_rate", "cross_border_amount",
             "alerts_raised", "alert_rate", "analyst_years", "rule_firings", "firings_per_txn",
             "txns_with_any_rule", "any_rule_rate", "firings_per_alert"]


def _reach(home: str) -> dict:
    """Tables reachable from ``home`` following many->one: table -> join path."""
    out, frontier = {home: []}, [home]
    while frontier:
        t = frontier.pop()
        for many, mk, one, ok in RELATIONSHIPS:
            if many == t and one not in out:
                out[one] = out[t] + [(many, mk, one, ok)]
                frontier.append(one)
    return out


def _split(attr: str):
    t, c = attr.split(".", 1)
    return t, c


def _alias(attr: str) -> str:
    return _split(attr)[1]


def _frame(tables: dict, home: str, attrs: list[str]) -> DataFrame:
    """The home table joined to the tables holding ``attrs`` (only those)."""
    reach = _reach(home)
    df = tables[home]
    joined = {home}
    needed = {home: set()}
    for a in attrs:
        t, c = _split(a)
        needed.setdefault(t, set()).add(c)
    for t in sorted(needed, key=lambda x: len(reach[x])):
        for many, mk, one, ok in reach[t]:
            if one in joined:
                continue
            cols = {ok} | needed.get(one, set())
            for nxt_many, nxt_mk, nxt_one, _ in RELATIONSHIPS:  # keys onward hops need
                if nxt_many == one and nxt_one in needed:
                    cols.add(nxt_mk)
            right = tables[one].select(F.col(ok).alias(f"__k_{one}"),
                                       *[F.col(x).alias(f"{one}__{x}") for x in sorted(cols)])
            left_key = F.col(mk) if many == home else F.col(f"{many}__{mk}")
            df = df.join(right, left_key == F.col(f"__k_{one}"), "left")
            joined.add(one)
    return df


def _attr_col(home: str, attr: str) -> Column:
    t, c = _split(attr)
    return F.col(c) if t == home else F.col(f"{t}__{c}")


def _expand(measures: list[str]) -> tuple[list[str], list[str]]:
    """The base measures that ``measures`` need, and all of them in an order in which each comes after what it needs."""
    base, order = [], []

    def need(k):
        m = MEASURES[k]
        for d in m.deps:
            need(d)
        if not m.derived and k not in base:
            base.append(k)
        if k not in order:
            order.append(k)
    for k in measures:
        need(k)
    return base, order


def finish(df: DataFrame, by: list[str], measures: list[str], cents: bool = False) -> DataFrame:
    """Derived measures from base columns, and blank rows dropped. ``cents``: money as whole hundredths."""
    base, order = _expand(measures)
    vals = {k: F.col(k) for k in base}
    for k in order:
        if MEASURES[k].derived:
            vals[k] = MEASURES[k].derived(vals)
    show = lambda k: (vals[k] * 100).cast("long") if cents and k in MONEY else vals[k]
    out = df.select(*[_alias(a) for a in by], *[show(k).alias(k) for k in measures])
    if by:
        out = out.filter(F.coalesce(*[F.when(F.col(k).isNotNull(), F.lit(True)) for k in measures], F.lit(False)))
    return out


def evaluate(tables: dict, measures: list[str], by=(), where: dict | None = None, cents: bool = False) -> DataFrame:
    """One aggregate and one scan a table; a measure whose filter replaces a grouping attribute is summed up over it after."""
    by, where = list(by), dict(where or {})
    base, _ = _expand(measures)

    # Base measures by table, grouping attributes they can reach and outer filters that hold for them.
    pieces: dict = {}
    for k in base:
        m = MEASURES[k]
        reach = _reach(m.table)
        over = m.filter_col in by and m.kind in ("count", "sum")  # additive: summed up over the replaced attribute afterwards
        app = tuple(a for a in by if _split(a)[0] in reach and (over or a != m.filter_col))
        wh = tuple((a, v) for a, v in where.items() if _split(a)[0] in reach and a != m.filter_col)
        pieces.setdefault((m.table, app, wh), []).append(k)

    results = []
    for (home, app, wh), keys in pieces.items():
        df = _frame(tables, home, list(app) + [a for a, _ in wh])
        for a, v in wh:
            df = df.filter(_attr_col(home, a) == F.lit(v))
        gcols = [_attr_col(home, a).alias(_alias(a)) for a in app]
        aggs = [MEASURES[k].agg(bool(gcols)).alias(k) for k in keys]
        r = df.groupBy(*gcols).agg(*aggs) if gcols else df.agg(*aggs)
        for k in keys:
            if MEASURES[k].filter_col in app:
                rest = [_alias(a) for a in app if a != MEASURES[k].filter_col]
                r = r.withColumn(k, F.sum(k).over(Window.partitionBy(*rest)))  # a row for each group
        results.append((app, r))

    names = [_alias(a) for a in by]
    full = [r for app, r in results if len(app) == len(by)]
    if not by:
        out = results[0][1]
        for _, r in results[1:]:
            out = out.crossJoin(F.broadcast(r))  # one row each
        return finish(out, by, measures, cents)
    if full:  # pieces of the same groups are put under each other and grouped once more
        out = full[0]
        for r in full[1:]:
            out = out.unionByName(r, allowMissingColumns=True)
        if len(full) > 1:
            out = out.groupBy(*names).agg(*[F.max(c).alias(c) for c in out.columns if c not in names])
    else:
        home = FT if any(_split(a)[0] in _reach(FT) for a in by) else FA
        out = _frame(tables, home, by).select(*[_attr_col(home, a).alias(_alias(a)) for a in by]).distinct()
    for i, (app, r) in enumerate(results):
        if len(app) == len(by):
            continue
        if not app:
            out = out.crossJoin(F.broadcast(r))  # one row
            continue
        keys = [_alias(a) for a in app]
        rk = r.select(*[F.col(k).alias(f"__r{i}_{k}") for k in keys], *[c for c in r.columns if c not in keys])
        out = out.join(rk, [out[k].eqNullSafe(rk[f"__r{i}_{k}"]) for k in keys], "left").drop(*[f"__r{i}_{k}" for k in keys])
    return finish(out, by, measures, cents)
