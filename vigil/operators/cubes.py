"""Stored cubes of additive measures: several cubes from one scan, and coarser ones from finer ones without a scan.

A cube keeps parts that add up: a count, a sum, and for an average its sum and its count. A distinct count does not add up;
asking for one is an error, unless the cube was made with ``sketches``, which keep its HyperLogLog sketch beside the parts and
give an estimate under ``<measure>_estimate``. The exact count stays with ``metrics.evaluate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import metrics as M

CUBE = "cube"


class NotAdditive(ValueError):
    """A measure that cannot be rolled up."""


def _parts(k: str, sketches: bool) -> dict[str, Column]:
    """The stored columns of a base measure over fact rows."""
    m = M.MEASURES[k]
    value = F.lit(1) if m.col is None else F.col(m.col)
    if m.filter is not None:
        value = F.when(m.filter(), value)
    if m.kind == "distinct":
        if not sketches:
            raise NotAdditive(f"{k} counts different values and does not add up")
        return {f"{k}__sketch": F.hll_sketch_agg(value)}
    if m.kind == "avg":
        return {f"{k}__sum": F.sum(value), f"{k}__n": F.count(value)}
    return {k: (F.count if m.kind == "count" else F.sum)(value)}


def _rolled(column: str) -> Column:
    return F.hll_union_agg(column) if column.endswith("__sketch") else F.sum(column)


def _base(measures: list[str]) -> list[str]:
    base, _ = M._expand(measures)
    for k in base:
        if M.MEASURES[k].table != M.FT:
            raise NotAdditive(f"{k} is not a measure of {M.FT}")
    return base


def build(tables: dict, cubes: dict[str, list[str]], measures: list[str], sketches: bool = False) -> DataFrame:
    """All ``cubes`` (name: attributes) from one scan of the fact, with grouping sets. A row has its cube's name, that cube's
    attributes (NULL for the others) and the parts of the measures."""
    attrs = list(dict.fromkeys(a for by in cubes.values() for a in by))
    base = _base(measures)
    needed = {M.MEASURES[k].col for k in base if M.MEASURES[k].col} | {M._split(M.MEASURES[k].filter_col)[1] for k in base if M.MEASURES[k].filter_col}
    names = [M._alias(a) for a in attrs]
    frame = M._frame(tables, M.FT, attrs).select(*[M._attr_col(M.FT, a).alias(f"__g_{M._alias(a)}") for a in attrs], *sorted(needed))
    parts = {n: c for k in base for n, c in _parts(k, sketches).items()}
    sets = [[F.col(f"__g_{M._alias(a)}") for a in by] for by in cubes.values()]
    out = frame.groupingSets(sets, *[F.col(f"__g_{n}") for n in names]).agg(F.grouping_id().alias("__id"), *[c.alias(n) for n, c in parts.items()])
    bits = {a: 1 << (len(attrs) - 1 - i) for i, a in enumerate(attrs)}  # a bit is set where an attribute is left out
    label = None
    for name, by in cubes.items():
        mine = F.col("__id") == sum(b for a, b in bits.items() if a not in by)
        label = F.when(mine, name) if label is None else label.when(mine, name)
    return out.select(label.alias(CUBE), *[F.col(f"__g_{n}").alias(n) for n in names], *parts)


def roll_up(cube: DataFrame, by: list[str], measures: list[str], sketches: bool = False, cents: bool = False) -> DataFrame:
    """Measures by fewer attributes, from a stored cube alone."""
    base = _base(measures) if measures else []
    names = [M._alias(a) for a in by]
    if missing := [n for n in names if n not in cube.columns]:
        raise NotAdditive(f"the cube has no {missing}")
    replaced = [k for k in base if M.MEASURES[k].filter_col in by]
    if replaced:
        raise NotAdditive(f"the filter of {replaced} replaces an attribute of the cube")
    columns = [n for k in base for n in _parts(k, sketches)]
    out = cube.groupBy(*names).agg(*[_rolled(n).alias(n) for n in columns])
    for k in base:
        if M.MEASURES[k].kind == "avg":
            out = out.withColumn(k, F.col(f"{k}__sum").cast("double") / F.col(f"{k}__n"))
        elif M.MEASURES[k].kind == "distinct":
            out = out.withColumn(f"{k}_estimate", F.hll_sketch_estimate(f"{k}__sketch"))
        elif M.MEASURES[k].kind == "count" and M.MEASURES[k].filter is not None and names:
            out = out.withColumn(k, F.when(F.col(k) > 0, F.col(k)))
    estimates = [k for k in measures if M.MEASURES[k].kind == "distinct"]
    if estimates:
        return out.select(*names, *[k for k in measures if k not in estimates], *[f"{k}_estimate" for k in estimates])
    return M.finish(out, by, measures, cents)
