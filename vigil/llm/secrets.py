"""Secrets in texts: fixed patterns, and character Markov models for random strings. DataFrame functions only.

Base kinds, leftmost and non-overlapping each: ``assign`` (a key word, a sign, a value of 12 or more), ``access`` (a key
id) and ``hex``. The fourth kind, ``markov``, looks at every run of 16 or more characters of the key alphabet that no
base span touches, and keeps those that a Markov model of random strings explains better than a model of ordinary
identifiers, by a log-likelihood ratio of ``MARGIN`` or more.

Both models are first-order character models (smoothed by single characters) trained on labelled samples that the corpus gives,
all of it: values of base matches are the random strings; runs of letters, each part of one case, are the
ordinary identifiers. Their counts are at most 128 x 128 numbers, the only thing that is broadcast.

Places count code points, end exclusive. They come from the lengths of what a split leaves between matches.
Defined results: null or empty texts have no spans; repeated rows score alike; with no samples of a kind its model is
uniform, so a run must then be unlikely under the other; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

_either = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
#: Fixed patterns of the base kinds, in their order.
KEYS = "|".join(_either(w) for w in ("password", "passwd", "secret", "token")) + "|" + _either("api") + "_?" + _either("key")
ASSIGN = rf"""({KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX, RUN = "AKIA[A-Z0-9]{14,}", "[0-9a-f]{16,}", "[A-Za-z0-9+/=_-]{16,}"
KINDS = ("assign", "access", "hex", "markov")
#: Runs that teach the model of ordinary identifiers: parts of one case each.
ORDINARY = "^([A-Z]?[a-z]+|[A-Z]+)([_-]([A-Z]?[a-z]+|[A-Z]+))*$"
#: Least log-likelihood ratio of a run, and of a run by its characters; weight of the single-character prior.
MARGIN, MARKOV_MARGIN_PER_CHAR, PRIOR, CODES = 8.0, 0.25, 16.0, 128
_SPAN = "array<struct<start:int,stop:int,value:string>>"


def _spans(text: Column, pattern: str, group: int = 0) -> Column:
    """``start, stop, value`` of every match; a match's start is the length of all before it."""
    between = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = matches if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    zipped = F.arrays_zip(F.transform(between, lambda x: F.length(x)).alias("gap"), F.transform(matches, lambda x: F.length(x)).alias("n"), values.alias("value"))
    step = lambda a, x: F.struct(
        (a["at"] + x["gap"] + F.coalesce(x["n"], F.lit(0))).alias("at"),
        F.when(x["n"].isNull(), a["done"]).otherwise(F.array_append(a["done"], F.struct((a["at"] + x["gap"]).alias("start"), (a["at"] + x["gap"] + x["n"]).alias("stop"), x["value"].alias("value")))).alias("done"))
    none = F.array().cast(_SPAN)
    found = F.aggregate(zipped, F.struct(F.lit(0).alias("at"), none.alias("done")), step, lambda a: a["done"])
    return F.when(text.rlike(pattern), found).otherwise(none)


def base_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, the spans of each base kind, and the runs that no base span touches."""
    two = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    t, none = F.col("t"), F.array().cast(_SPAN)
    # What holds access keys and hex strings is a long run too: texts without one are done after one look.
    two = two.withColumn("long", t.rlike(RUN))
    in_long = lambda p: F.when(F.col("long"), _spans(t, p)).otherwise(none)
    found = two.select("id", F.filter(_spans(t, ASSIGN, 2), lambda s: F.length(s["value"]) >= 12).alias("assign"), in_long(ACCESS).alias("access"), in_long(HEX).alias("hex"), in_long(RUN).alias("run"))
    touched = lambda r: F.exists(F.concat("assign", "access", "hex"), lambda b: (b["start"] < r["stop"]) & (r["start"] < b["stop"]))
    return found.withColumn("run", F.filter("run", lambda r: ~touched(r)))


def _pair_code(s: Column, i: Column) -> Column:
    return F.ascii(F.substring(s, i, F.lit(1))) * CODES + F.ascii(F.substring(s, i + 1, F.lit(1)))


def ratios(found: DataFrame) -> DataFrame:
    """One row: ``model``, for each pair of characters log p(second | first) of random strings less that of identifiers."""
    randoms = F.transform(F.concat("assign", "access", "hex"), lambda s: F.struct(s["value"].alias("s"), F.lit(1).alias("random")))
    plain = F.transform(F.filter("run", lambda r: r["value"].rlike(ORDINARY)), lambda s: F.struct(s["value"].alias("s"), F.lit(0).alias("random")))
    samples = found.select(F.explode(F.concat(randoms, plain)).alias("x")).select("x.s", "x.random").where(F.length("s") > 1)
    pairs = samples.select("random", F.explode(F.transform(F.sequence(F.lit(1), F.length("s") - 1), lambda i: _pair_code(F.col("s"), i))).alias("code"))
    counts = pairs.groupBy("code").agg(F.sum("random").alias("r"), F.sum(1 - F.col("random")).alias("o"))
    grid = found.sparkSession.range(CODES * CODES).select(F.col("id").cast("int").alias("code")).join(counts, "code", "left").na.fill(0, ["r", "o"])
    grid = grid.select("r", "o", "code", F.floor(F.col("code") / CODES).alias("a"), (F.col("code") % CODES).alias("b"))
    first = grid.groupBy("a").agg(F.sum("r").alias("ra"), F.sum("o").alias("oa"))
    second = grid.groupBy("b").agg(F.sum("r").alias("rb"), F.sum("o").alias("ob"))
    every = grid.agg(F.sum("r").alias("rn"), F.sum("o").alias("on"))
    grid = grid.join(first, "a").join(second, "b").crossJoin(F.broadcast(every))  # one row
    # Pairs that a sample lacks fall back to how often their second character comes at all.
    p = lambda both, of, to, n: (F.col(both) + PRIOR * (F.col(to) + 1) / (F.col(n) + 64)) / (F.col(of) + PRIOR)
    each = F.log(p("r", "ra", "rb", "rn")) - F.log(p("o", "oa", "ob", "on"))
    return grid.agg(F.transform(F.array_sort(F.collect_list(F.struct("code", each.alias("v")))), lambda x: x["v"]).alias("model"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", margin: float = MARGIN, per_char: float = MARKOV_MARGIN_PER_CHAR) -> DataFrame:
    """``id, spans``: ``array<struct<start, kind_order, stop, kind>>`` sorted, for every input row."""
    found = materialize(base_spans(docs, id_col, text_col), "secret_runs")
    scored = found.crossJoin(F.broadcast(ratios(found)))  # one row of CODES x CODES numbers
    ratio = lambda s: F.aggregate(F.sequence(F.lit(1), F.length(s) - 1), F.lit(0.0), lambda a, i: a + F.element_at("model", _pair_code(s, i) + 1))
    marked = F.filter("run", lambda r: ratio(r["value"]) >= F.greatest(F.lit(float(margin)), F.lit(float(per_char)) * F.length(r["value"])))
    one = lambda k: lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind_order"), s["stop"].alias("stop"), F.lit(KINDS[k]).alias("kind"))
    every = [F.transform("assign", one(0)), F.transform("access", one(1)), F.transform("hex", one(2)), F.transform(marked, one(3))]
    return scored.select("id", F.array_sort(F.concat(*every)).alias("spans"))


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
