"""Change data capture: decode change lines, coerce, mark, compact, apply.

Works on batch and streaming DataFrames alike (every step up to
``compact`` is a projection). Input records look like::

    table <schema>.<table>: INSERT|UPDATE|DELETE: name[type]:value name[type]:value ...

Text values are single-quoted with doubled inner quotes and may hold line
ends; the bare token ``null`` is NULL; ``''`` is the empty string. An update
that changes the key has ``old-key:`` fields before ``new-tuple:`` fields and
becomes a delete and an update. A column marked ``unchanged-toast-datum``
keeps the value it had. ``BEGIN``/``COMMIT`` lines are skipped. All else goes
to a quarantine output with its reason: lines that are no change, payloads
that are not understood to their end, repeated columns, changes without a
tuple, and changes whose key is NULL or does not parse. Decoding is columnar
(one tokenising pass + higher-order functions): no Python per row.

The order of changes is any orderable column, e.g. a struct of batch, file
and position; nothing is packed into one number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Line grammar and markers.
# ---------------------------------------------------------------------------
NAME = r'"(?:[^"]|"")+"|[^".:\s]+'
SCHEMA_TABLE = rf"^table ({NAME})\.({NAME}): "
# A field: name, type in brackets (itself with brackets for arrays), value.
COLUMN, TYPE, VALUE = r'"(?:[^"]|"")+"|[^"\[\s]+', r"(?:[^\[\]]|\[\])*", r"'(?:[^']|'')*+'|[^\s']+"
FIELD_TYPE, QUOTED = rf"^({TYPE})\]:", r'^("(?:[^"]|"")+")'
OLD_KEY, NEW_TUPLE, NO_TUPLE, UNCHANGED = "old-key:", "new-tuple:", "(no-tuple-data)", "unchanged-toast-datum"
TOKEN = rf"(?:old-key:|new-tuple:|\(no-tuple-data\)|(?:{COLUMN})\[{TYPE}\]:(?:{VALUE}))"
# The header, then tokens that follow each other without a gap: all that is understood of a record, cut in one pass.
LEXEME = rf"^table (?:{NAME})\.(?:{NAME}): (?:INSERT|UPDATE|DELETE):(?: |$)|\G{TOKEN}(?: +|(?=\n)|$)"
CONTROL = r"^(?:BEGIN|COMMIT)(?: [^\n]*)?$"
RECORD_START = r"\n(?=table |BEGIN|COMMIT)"
ROW_MARKER, UNCHANGED_COL = "__rowMarker__", "__unchanged__"
MARKERS = {"INSERT": "0", "UPDATE": "1", "DELETE": "2", "UPSERT": "4"}
TRUE_TEXT = ("t", "true", "TRUE", "1")
FIELD_STRUCT = "array<struct<name:string,type:string,value:string>>"
MARKS = (OLD_KEY, NEW_TUPLE, NO_TUPLE)


def _unquote(x: Column, q: str) -> Column:
    inner = F.substring(x, F.lit(2), F.length(x) - 2)
    return F.when(x.startswith(q) & x.endswith(q) & (F.length(x) >= 2),
                  F.replace(inner, F.lit(q + q), F.lit(q))).otherwise(x)


def records(text: Column) -> Column:
    """The records of a change file: a value may hold line ends, so a record
    ends where the next one starts."""
    return F.split(text, RECORD_START)


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once a row, however often later steps and filters name them: neither projections nor
    predicates are merged through the generator."""
    one = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.explode(F.array(one)).alias("__once")).select("*", "__once.*").drop("__once")


def _fields(tokens: Column) -> Column:
    """Tokens as ``(mark, name, type, value)``: either a mark or a field."""
    raw = F.transform(tokens, lambda t: F.struct(t.alias("t"), F.when(t.startswith('"'), F.regexp_extract(t, QUOTED, 1)).otherwise(F.substring_index(t, "[", 1)).alias("n")))
    raw = F.transform(raw, lambda x: F.struct(x["t"].alias("t"), x["n"].alias("n"), F.regexp_extract(F.substring(x["t"], F.length(x["n"]) + 2, F.length(x["t"])), FIELD_TYPE, 1).alias("k")))
    return F.transform(raw, lambda x: F.struct(
        F.when(x["t"].isin(*MARKS), x["t"]).alias("mark"), _unquote(x["n"], '"').alias("name"), x["k"].alias("type"),
        F.substring(x["t"], F.length(x["n"]) + F.length(x["k"]) + 4, F.length(x["t"])).alias("value")))


def _own(fields: Column) -> Column:
    return F.filter(fields, lambda f: f["mark"].isNull())


def parse(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Adds ``__head``, ``__fields``, ``__cut`` (where the new tuple starts, else 0), ``__tail`` (lines after the record that
    belong to no record) and ``__reason`` (why it is no change, or NULL)."""
    v = F.col(value_col)
    df = _once(lines, __lex=F.regexp_extract_all(v, F.lit(LEXEME), 0))
    lex = F.col("__lex")
    change = F.coalesce(F.get(lex, F.lit(0)).startswith("table "), F.lit(False))
    end = F.aggregate(lex, F.lit(0), lambda n, t: n + F.length(t))
    tokens = F.transform(F.slice(lex, F.lit(2), F.greatest(F.size(lex) - 1, F.lit(0))), lambda t: F.rtrim(t))
    df = _once(df, __head=F.when(change, F.get(lex, F.lit(0))), __fields=F.when(change, _fields(tokens)), __tail=F.when(change, F.substring(v, end + 1, F.length(v))))
    fields = F.col("__fields")
    df = _once(df, __cut=F.array_position(F.transform(fields, lambda f: F.coalesce(f["mark"], F.lit(""))), NEW_TUPLE))
    # old-key and new-tuple may both have a column; within one of them it is there once.
    names = lambda f: F.transform(_own(f), lambda x: x["name"])
    twice = lambda f: F.size(names(f)) != F.size(F.array_distinct(names(f)))
    repeated = twice(_before()) | twice(_after())
    tail = F.col("__tail")
    reason = (F.when(tail.isNull(), "not a change").when((tail != "") & ~tail.startswith("\n"), "payload not understood")
              .when(F.size(_own(fields)) == 0, "no tuple").when(repeated, "repeated column"))
    return _once(df, __reason=reason).drop("__lex")


def _before() -> Column:
    return F.slice("__fields", F.lit(1), F.greatest(F.col("__cut") - 1, F.lit(0)).cast("int"))


def _after() -> Column:
    return F.slice("__fields", (F.col("__cut") + 1).cast("int"), F.size("__fields"))


def _maps(fields: Column) -> list[Column]:
    known = F.filter(fields, lambda f: f["value"] != UNCHANGED)
    value = lambda f: F.when(f["value"] == "null", F.lit(None).cast("string")).otherwise(_unquote(f["value"], "'"))
    return [F.map_from_entries(F.transform(known, lambda f: F.struct(f["name"], value(f)))).alias("fields"),
            F.map_from_entries(F.transform(known, lambda f: F.struct(f["name"], f["type"]))).alias("field_types"),
            F.transform(F.filter(fields, lambda f: f["value"] == UNCHANGED), lambda f: f["name"]).alias(UNCHANGED_COL)]


def decode(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Records -> (schema_name, table_name, op, part, marker, fields and field_types by name, unchanged columns);
    other columns (e.g. an order) are kept. ``part`` orders the delete (0) and the update (1) of a change of key."""
    keep = [c for c in lines.columns if c != value_col]
    return decode_parsed(parse(lines, value_col), keep)


def decode_parsed(parsed: DataFrame, keep: list[str]) -> DataFrame:
    """``decode`` for records that ``parse`` has read."""
    p = _once(parsed.filter(F.col("__reason").isNull()), __s=F.regexp_extract("__head", SCHEMA_TABLE, 1), __t=F.regexp_extract("__head", SCHEMA_TABLE, 2))
    part = lambda n, op, fields: F.struct(F.lit(n).alias("part"), op.alias("op"), F.transform(_own(fields), lambda f: F.struct(f["name"].alias("name"), f["type"].alias("type"), f["value"].alias("value"))).cast(FIELD_STRUCT).alias("f"))
    head = F.col("__head")
    op = F.substring_index(F.substring_index(F.rtrim(head), ":", -2), ":", 1)
    each = F.when(F.col("__cut") > 0, F.array(part(0, F.lit("DELETE"), _before()), part(1, F.ltrim(op), _after()))).otherwise(F.array(part(1, F.ltrim(op), F.col("__fields"))))
    out = p.select(*keep, _unquote(F.col("__s"), '"').alias("schema_name"), _unquote(F.col("__t"), '"').alias("table_name"), F.explode(each).alias("__c"))
    # A full old tuple with the same values says nothing that the update does not.
    out = out.select(*keep, "schema_name", "table_name", F.col("__c.op").alias("op"), F.col("__c.part").alias("part"), *_maps(F.col("__c.f")))
    return out.withColumn(ROW_MARKER, mark(F.col("op")))


def quarantine(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Records that are neither a change nor BEGIN/COMMIT, and lines that follow a record without being one, with
    the ``reason``."""
    return quarantine_parsed(parse(lines, value_col), [c for c in lines.columns if c != value_col], value_col)


def quarantine_parsed(p: DataFrame, keep: list[str], value_col: str = "value") -> DataFrame:
    """``quarantine`` for records that ``parse`` has read."""
    v = F.col(value_col)
    control = v.rlike(CONTROL)
    whole = F.when(F.col("__reason").isNotNull() & ~control & (F.trim(v) != ""), F.struct(v.alias("value"), F.col("__reason").alias("reason")))
    # After BEGIN or COMMIT the rest of the chunk is junk as well.
    rest = F.when(F.col("__reason").isNull() & F.col("__tail").startswith("\n"), F.col("__tail"))
    junk = F.transform(F.filter(F.split(F.coalesce(rest, F.lit("")), "\n"), lambda x: F.trim(x) != ""), lambda x: F.struct(x.alias("value"), F.lit("not a change").alias("reason")))
    # Lines after a BEGIN or COMMIT, or junk in several lines, are single lines too.
    lone = F.transform(F.filter(F.split(whole["value"], "\n"), lambda x: (F.trim(x) != "") & ~x.rlike(CONTROL)), lambda x: F.struct(x.alias("value"), whole["reason"].alias("reason")))
    found = F.when(whole.isNull(), junk).when(whole["reason"] == "not a change", lone).otherwise(F.array(whole))
    return p.select(*keep, F.explode(found).alias("__q")).select(*keep, F.col("__q.value").alias(value_col), F.col("__q.reason").alias("reason"))


def mark(op: Column) -> Column:
    """Operation -> row marker: 0 insert, 1 update, 2 delete, 4 upsert."""
    out = None
    for k, m in MARKERS.items():
        out = F.when(op == k, F.lit(m)) if out is None else out.when(op == k, F.lit(m))
    return out


def coerce(decoded: DataFrame, target: T.StructType, schema_name: str | None = None,
           table_name: str | None = None, keep=(), unchanged: bool = False) -> DataFrame:
    """Fields map -> typed target columns (in target order) + marker last.
    A value that does not parse is NULL; booleans are true for t/true/TRUE/1.
    ``unchanged`` keeps the list of columns whose value a change leaves as it was."""
    df = decoded
    if schema_name is not None:
        df = df.filter(F.col("schema_name") == schema_name)
    if table_name is not None:
        df = df.filter(F.col("table_name") == table_name)
    cols = []
    for f in target.fields:
        raw = F.element_at(F.col("fields"), F.lit(f.name))
        if isinstance(f.dataType, T.BooleanType):
            c = F.when(raw.isNull(), F.lit(None).cast("boolean")).otherwise(raw.isin(*TRUE_TEXT))
        elif isinstance(f.dataType, T.StringType):
            c = raw
        else:
            c = raw.try_cast(f.dataType)
        cols.append(c.alias(f.name))
    unchanged = [F.col(UNCHANGED_COL)] if unchanged else []
    return df.select(*keep, *cols, *unchanged, F.col(ROW_MARKER))


def bad_keys(typed: DataFrame, key: str) -> DataFrame:
    """Changes that name no row: their key is NULL or does not parse. They are quarantined, never applied."""
    return typed.filter(F.col(key).isNull()).withColumn("reason", F.lit("no key"))


def good_keys(typed: DataFrame, key: str) -> DataFrame:
    return typed.filter(F.col(key).isNotNull())


def check_schema(expected: T.StructType, actual: T.StructType, spark) -> DataFrame:
    """Change-file preflight: missing, extra, type mismatch, order (metadata only)."""
    exp = {f.name: f.dataType.simpleString() for f in expected.fields}
    own = (ROW_MARKER, UNCHANGED_COL)
    act = {f.name: f.dataType.simpleString() for f in actual.fields if f.name not in own}
    rows = [("missing", n, exp[n], None) for n in exp if n not in act]
    rows += [("extra", n, None, act[n]) for n in act if n not in exp]
    rows += [("type", n, exp[n], act[n]) for n in exp if n in act and exp[n] != act[n]]
    order_a = [f.name for f in actual.fields if f.name not in own]
    if [n for n in order_a if n in exp] != [n for n in exp if n in act]:
        rows.append(("order", None, None, None))
    if actual.fields and actual.fields[-1].name != ROW_MARKER:
        rows.append(("marker_not_last", ROW_MARKER, None, None))
    return spark.createDataFrame(rows, "issue string, column_name string, expected string, actual string")


def feed_columns(decoded: DataFrame, expected: dict[str, str]) -> DataFrame:
    """The columns and types that a feed's lines declare, against ``expected`` (declared type by name): ``column_name,
    declared, changes`` (that name the column so) and ``issue``: ``extra``, ``type``, ``missing`` or NULL. Counted before
    anything moves: a row for each name and type."""
    seen = decoded.select(F.explode("field_types").alias("column_name", "declared")).groupBy("column_name", "declared").agg(F.count(F.lit(1)).alias("changes"))
    want = F.broadcast(decoded.sparkSession.createDataFrame(list(expected.items()), "__name string, __type string"))  # a row a column
    both = seen.join(want, F.col("column_name") == F.col("__name"), "full_outer")
    issue = (F.when(F.col("column_name").isNull(), "missing").when(F.col("__name").isNull(), "extra").when(F.col("declared") != F.col("__type"), "type"))
    return both.select(F.coalesce("column_name", "__name").alias("column_name"), "declared", F.coalesce("changes", F.lit(0)).alias("changes"), issue.alias("issue"))


def seed(df: DataFrame) -> DataFrame:
    """A snapshot without markers: every row is an insert."""
    return df.withColumn(ROW_MARKER, F.lit("0"))


def compact(changes: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """Last change per key wins (by ``seq``, any orderable column). A partial
    aggregate (``max_by`` combines map-side), so a hot key costs one row per
    task. A key inserted then deleted in the batch keeps its delete. Columns
    that the last change leaves unchanged take the last value in the batch;
    those without one stay listed as unchanged. Changes without a key are not
    applied: see ``bad_keys``."""
    changes = good_keys(changes, key)
    cols = [c for c in changes.columns if c != key]
    if UNCHANGED_COL not in cols:
        last = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(seq))
        return changes.groupBy(key).agg(last.alias("__last")).select(key, "__last.*")
    own = [c for c in cols if c not in (seq, UNCHANGED_COL, ROW_MARKER)]
    told = lambda c: ~F.array_contains(UNCHANGED_COL, c)
    out = changes.groupBy(key).agg(
        F.max(seq).alias(seq), F.max_by(ROW_MARKER, seq).alias(ROW_MARKER),
        *[F.max_by(F.struct(c), F.when(told(c), F.col(seq))).alias(f"__v_{c}") for c in own])
    still = F.filter(F.array(*[F.when(F.col(f"__v_{c}").isNull(), F.lit(c)) for c in own]), lambda x: x.isNotNull()) if own else F.array().cast("array<string>")
    value = {c: F.col(f"__v_{c}")[c].alias(c) for c in own}
    return out.select(key, *[still.alias(c) if c == UNCHANGED_COL else value.get(c, F.col(c)) for c in cols])


def apply(snapshot: DataFrame, compacted: DataFrame, key: str) -> DataFrame:
    """Insert/update replace the row with that key; delete removes it; rows
    untouched by the batch pass through, a row with a NULL key too.

    One full outer join on the key, so the snapshot and the batch are each
    read once (the batch side is small per micro-batch; AQE broadcasts it
    when its measured size allows and otherwise shuffles both on the key)."""
    target_cols = [c for c in snapshot.columns if c != ROW_MARKER]
    compacted = good_keys(compacted, key)
    unchanged = F.col(UNCHANGED_COL) if UNCHANGED_COL in compacted.columns else F.array().cast("array<string>")
    b = compacted.select(F.col(key).alias("__bk"), F.col(ROW_MARKER).alias("__m"), unchanged.alias("__u"),
                         *[F.col(c).alias(f"__b_{c}") for c in target_cols if c != key])
    j = snapshot.select(*target_cols).join(b, F.col(key) == F.col("__bk"), "full_outer")
    hit = F.col("__bk").isNotNull()
    out = [F.when(hit, F.col("__bk")).otherwise(F.col(key)).alias(key) if c == key
           else F.when(hit & ~F.array_contains("__u", c), F.col(f"__b_{c}")).otherwise(F.col(c)).alias(c) for c in target_cols]
    return j.filter(~hit | (F.col("__m") != MARKERS["DELETE"])).select(*out)


def before_all(kind: T.DataType) -> Column:
    """An order value below every change: -1 or the empty string, in each part of a struct."""
    if isinstance(kind, T.StructType):
        return F.struct(*[before_all(f.dataType).alias(f.name) for f in kind.fields])
    return F.lit("" if isinstance(kind, T.StringType) else -1).cast(kind)


def current_view(seed_df: DataFrame, changes: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """Merge-on-read: latest version by key over seed + change feed."""
    s = seed(seed_df).withColumn(seq, before_all(changes.schema[seq].dataType))
    if UNCHANGED_COL in changes.columns:
        s = s.withColumn(UNCHANGED_COL, F.array().cast("array<string>"))
    cols = [c for c in changes.columns]
    merged = s.select(*cols).unionByName(changes.select(*cols))
    last = compact(merged, key, seq)
    return last.filter(F.col(ROW_MARKER) != MARKERS["DELETE"]).drop(ROW_MARKER, seq, UNCHANGED_COL)


def batch_stats(changes: DataFrame) -> DataFrame:
    """Inserts / updates / deletes in a batch."""
    m = F.col(ROW_MARKER)
    return changes.agg(F.count_if(m == "0").alias("inserts"), F.count_if(m == "1").alias("updates"),
                       F.count_if(m == "2").alias("deletes"), F.count_if(m == "4").alias("upserts"))


def verify(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Acceptance of a run: rows by what became of their key (inserted, deleted, changed or same)."""
    cols = [c for c in before.columns if c != key]
    a = before.select(F.col(key).alias("__a"), F.struct(*cols).alias("__x"))
    b = after.select(F.col(key).alias("__b"), F.struct(*cols).alias("__y"))
    status = (F.when(F.col("__a").isNull(), "inserted").when(F.col("__b").isNull(), "deleted")
              .when(F.col("__x").eqNullSafe(F.col("__y")), "same").otherwise("changed"))
    return a.join(b, F.col("__a") == F.col("__b"), "full_outer").groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("rows"))


def history(feed: DataFrame, ts_col: str, retain_days: int = 7) -> DataFrame:
    """Change feed kept for ``retain_days`` before the newest change."""
    newest = feed.agg(F.max(ts_col).alias("__newest"))
    return (feed.crossJoin(F.broadcast(newest))  # one row
            .filter(F.col(ts_col) >= F.col("__newest") - F.expr(f"INTERVAL {retain_days} DAYS"))
            .drop("__newest"))
