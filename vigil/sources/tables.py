"""Batch sources: lake tables, CSV landing files, JDBC, key slices, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path_or_name: str, fmt: str | None = None) -> DataFrame:
    """Scan a table at its current snapshot: a catalog name or a path.

    Catalyst prunes columns and pushes filters into the parquet scan."""
    if fmt is None and "/" not in path_or_name:
        return spark.table(path_or_name)
    return spark.read.format(fmt or "parquet").load(path_or_name)


def all_text_schema(columns: list[str], key: str | None = "_mirror_row_id") -> T.StructType:
    """Fixed schema: every column text, optional bigint key. Never inferred."""
    fields = []
    for c in columns:
        dt = T.LongType() if c == key else T.StringType()
        fields.append(T.StructField(c, dt, True))
    return T.StructType(fields)


def read_raw_csv(spark: SparkSession, path: str, columns: list[str],
                 key: str | None = "_mirror_row_id", multi_line: bool = False) -> DataFrame:
    """CSV with a header, all text, '"' quote and escape. An unquoted empty
    field reads as NULL and a quoted empty field as '' -- the two stay apart.
    ``multi_line`` reads quoted line ends as part of the value; such a file is
    read by one task, so large exports should come as many files."""
    return (spark.read.schema(all_text_schema(columns, key))
            .option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line)
            .option("emptyValue", "").option("nullValue", "\u0000")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("mode", "PERMISSIVE").csv(path))


def read_jdbc(spark: SparkSession, url: str, table: str, key: str,
              lower: int, upper: int, partitions: int, properties: dict | None = None) -> DataFrame:
    """Read-only relational source, split into ``partitions`` key ranges so
    the scan runs in parallel. (Needs a JDBC driver jar on the cluster.)"""
    return spark.read.jdbc(url, table, column=key, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=properties or {})


def key_slice(df: DataFrame, n: int, key: str = "_mirror_row_id") -> DataFrame:
    """Deterministic slice by key range (a LIMIT without ORDER BY is not
    reproducible). The predicate is pushed into the scan."""
    return df.filter(F.col(key) <= F.lit(n))


def sample_rows(df: DataFrame, fraction: float | None = None, n: int | None = None,
                key: str = "_mirror_row_id", seed: int = 42) -> DataFrame:
    """Bernoulli sample by fraction, or exactly ``n`` rows chosen by a stable
    hash of the key (a top-n, so each task keeps at most n rows)."""
    if fraction is not None:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    if n is None:
        raise ValueError("give fraction or n")
    h = F.xxhash64(F.col(key), F.lit(seed))
    return df.withColumn("__h", h).orderBy("__h", key).limit(n).drop("__h")


def link_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """An external pointer to a table, no copy: a temp view over the path."""
    df = spark.read.format(fmt).load(path)
    df.createOrReplaceTempView(name)
    return spark.table(name)
