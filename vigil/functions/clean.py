"""Scalar cleaners: ``(Column | str) -> Column``.

All are built-in Spark expressions, so they stay inside whole-stage codegen
and can be used in batch and streaming projections alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's behaviour for equal results).
# ---------------------------------------------------------------------------
# Null look-alikes as the source cleaner matches them: the value is trimmed and
# lower-cased before the test, so only the lower-case members can ever match.
# 'NA' and '#N/A' therefore survive as values (parity behaviour).
NULLISH_PARITY = ("", "null", "n/a", "-", "unknown", "none")
# Stricter variant that also nulls 'na' and '#n/a'.
NULLISH_STRICT = NULLISH_PARITY + ("na", "#n/a")
# Junk list used by the raw profiler (exact case, after trim).
RAW_JUNK = ("", "NULL", "N/A", "NA", "-", "unknown", "none", "#N/A")
# Leading currency words stripped from money text (case-insensitive).
CURRENCY_WORDS = ("rm", "myr", "usd", "sgd", "eur", "gbp", "aud", "jpy")
# Date sentinels that mean "no date".
DATE_SENTINELS = ("1900-01-01", "9999-12-31", "0000-00-00", "1970-01-01")
# Date layouts tried in this order (day-first before month-first).
DATE_FORMATS = ("yyyy-M-d", "d/M/yyyy", "M/d/yyyy", "d-MMM-yy", "d.M.yyyy")
# Timestamp layouts tried in this order; then the first 19 characters as ISO.
TS_FORMATS = ("yyyy-M-d H:m:s", "yyyy-M-d'T'H:m:s", "d/M/yyyy H:m",
              "yyyy-M-d H:m:s.SSS")
TS_ISO_PREFIX = "yyyy-M-d'T'H:m:s"
# A bare epoch-seconds value.
EPOCH_PATTERN = r"^[0-9]{9,11}$"
# Boolean spellings.
TRUE_WORDS = ("y", "yes", "true", "1", "t")
FALSE_WORDS = ("n", "no", "false", "0", "f")
# Two-digit years at or above this pivot belong to the previous century
# (a 'yy' pattern always reads 20yy).
CENTURY_PIVOT_YEAR = 2069


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def raw_key(c) -> Column:
    """trim(coalesce(c, '')) -- the form every lookup test uses."""
    return F.trim(F.coalesce(_c(c), F.lit("")))


def is_nullish(c, nullish=NULLISH_PARITY, key: Column | None = None) -> Column:
    return F.lower(raw_key(c) if key is None else key).isin(*nullish)


def squeeze(c, key: Column | None = None) -> Column:
    """Trim, collapse inner whitespace runs to one space, '' and the literal
    text \\x00 become NULL."""
    body = F.regexp_replace(raw_key(c) if key is None else key, r"\s+", " ")
    return F.nullif(F.nullif(body, F.lit("")), F.lit("\\x00"))


def text(c, nullish=NULLISH_PARITY, key: Column | None = None, sq: Column | None = None) -> Column:
    """Null look-alikes to NULL, otherwise :func:`squeeze`.

    ``key`` / ``sq`` may carry ``raw_key(c)`` / ``squeeze(c)`` computed once
    upstream (see silver.build); results are identical."""
    return (F.when(is_nullish(c, nullish, key), F.lit(None).cast("string"))
            .otherwise(squeeze(c, key) if sq is None else sq))


def upper_text(c, nullish=NULLISH_PARITY, key: Column | None = None, sq: Column | None = None) -> Column:
    return F.upper(text(c, nullish, key, sq))


def _money_body(c, key: Column | None = None) -> Column:
    words = "|".join(CURRENCY_WORDS)
    no_word = F.regexp_replace(raw_key(c) if key is None else key, rf"(?i)^({words})\s*", "")
    return F.regexp_replace(no_word, r"[,\s]", "")


def money(c, nullish=NULLISH_PARITY, precision: int = 18, scale: int = 2,
          key: Column | None = None) -> Column:
    """Money text to DECIMAL(18,2): strip a leading currency word, thousands
    separators and spaces; '(x)' is the accounting negative; unparseable
    text is NULL."""
    dt = f"decimal({precision},{scale})"
    body = _money_body(c, key)
    unparen = F.replace(F.replace(body, F.lit("("), F.lit("")), F.lit(")"), F.lit(""))
    return (F.when(is_nullish(c, nullish, key), F.lit(None).cast(dt))
            .when(body.like("(%)"), -(unparen.try_cast(dt)))
            .otherwise(body.try_cast(dt)))


def _try_parse(c: Column, fmt: str) -> Column:
    """``fmt`` tried only where the text holds each sign that separates its fields: most attempts that would fail are
    never made."""
    signs = sorted({ch for ch in fmt.replace("'T'", "\0") if not ch.isalpha()})
    fits = F.lit(True)
    for ch in signs:
        fits = fits & c.contains(F.lit("T" if ch == "\0" else ch))
    return F.when(fits, F.try_to_timestamp(c, F.lit(fmt)))


def _first_parse(c: Column, formats) -> Column:
    return F.coalesce(*[_try_parse(c, f) for f in formats])


def date_multi(c, nullish=NULLISH_PARITY, formats=DATE_FORMATS, key: Column | None = None,
               sq: Column | None = None) -> Column:
    """Text in one of several date layouts to DATE. Sentinels and look-alikes
    are NULL. A two-digit year read at or past the pivot moves back a century."""
    sq = squeeze(c, key) if sq is None else sq
    k = raw_key(c) if key is None else key
    tries = []
    for f in formats:
        d = _try_parse(sq, f).cast("date")
        if "yy" in f and "yyyy" not in f:
            d = F.when(F.year(d) >= CENTURY_PIVOT_YEAR, F.add_months(d, -1200)).otherwise(d)
        tries.append(d)
    return (F.when(k.isin(*DATE_SENTINELS), F.lit(None).cast("date"))
            .when(is_nullish(c, nullish, k), F.lit(None).cast("date"))
            .otherwise(F.coalesce(*tries)))


def timestamp_multi(c, nullish=NULLISH_PARITY, formats=TS_FORMATS, key: Column | None = None,
                    sq: Column | None = None) -> Column:
    """Text in one of several timestamp layouts (or epoch seconds) to a
    TIMESTAMP read as UTC. A trailing offset such as '+08:00' is dropped,
    not applied: only the first 19 characters are read as ISO."""
    sq = squeeze(c, key) if sq is None else sq
    k = raw_key(c) if key is None else key
    epoch = F.timestamp_seconds(F.trim(_c(c)).try_cast("bigint"))
    iso = _try_parse(F.substring(sq, 1, 19), TS_ISO_PREFIX)
    return (F.when(is_nullish(c, nullish, k), F.lit(None).cast("timestamp"))
            .when(k.rlike(EPOCH_PATTERN), epoch)
            .otherwise(F.coalesce(_first_parse(sq, formats), iso)))


def flag(c, key: Column | None = None) -> Column:
    """Yes/no spellings to BOOLEAN, anything else NULL."""
    k = F.lower(raw_key(c) if key is None else key)
    return (F.when(k.isin(*TRUE_WORDS), F.lit(True))
            .when(k.isin(*FALSE_WORDS), F.lit(False))
            .otherwise(F.lit(None).cast("boolean")))


def matching(c, pattern: str, key: Column | None = None) -> Column:
    """The trimmed value when it matches ``pattern``, else NULL."""
    k = raw_key(c) if key is None else key
    return F.when(k.rlike(pattern), F.trim(_c(c))).otherwise(F.lit(None).cast("string"))


def scrape_number(c) -> Column:
    """Drop every character but digits and '.', then read as DOUBLE."""
    return F.regexp_replace(F.coalesce(_c(c), F.lit("")), r"[^0-9.]", "").try_cast("double")
