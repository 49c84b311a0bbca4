"""Batch sinks: raw CSV, snapshot export, gold export, layout-optimised tables,
publish-with-marker, evidence JSON."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_raw_csv(df: DataFrame, path: str, limit: int | None = None, mode: str = "overwrite") -> None:
    """CSV keeping NULL (unquoted empty field) and '' (quoted "") apart, and
    leading/trailing spaces intact (Spark's CSV writer trims by default).
    ``limit`` caps the rows written (the export's row cap is the feature)."""
    out = df.limit(limit) if limit is not None else df
    w = out.write.mode(mode)
    for k, v in RAW_CSV_WRITE.items():
        w = w.option(k, v)
    w.csv(path)


RAW_CSV_WRITE = {"header": "true", "quote": '"', "escape": '"', "emptyValue": '""', "nullValue": "",
                 "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def export_snapshot(df: DataFrame, path: str, files: int | None = None) -> None:
    """Zstd parquet, written in parallel by every task (one file per task)."""
    out = df.repartition(files) if files else df
    out.write.mode("overwrite").option("compression", "zstd").parquet(path)


def instants(df: DataFrame) -> DataFrame:
    """Local date-time columns become instants (session time zone, UTC)."""
    cast = {f.name: F.col(f.name).cast("timestamp") for f in df.schema.fields
            if isinstance(f.dataType, T.TimestampNTZType)}
    return df.withColumns(cast) if cast else df


def export_gold(tables: dict, base: str) -> dict:
    """Write each gold table as zstd parquet with instant timestamps."""
    out = {}
    for name, df in tables.items():
        p = f"{base}/{name}"
        instants(df).write.mode("overwrite").option("compression", "zstd").parquet(p)
        out[name] = p
    return out


def save_gold(df: DataFrame, table: str, sort_keys: list[str], files: int | None = None,
              build_id: str | None = None) -> None:
    """Overwrite a catalog table with a read-friendly layout: range-partition
    on the sort keys (sampled bounds, balanced files) and sort within files,
    so min/max statistics prune row groups. The layout and build id are
    recorded as table properties, read back by ``layout_evidence``."""
    spark = df.sparkSession
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = df.repartitionByRange(n, *sort_keys).sortWithinPartitions(*sort_keys)
    laid.write.mode("overwrite").format("parquet").option("compression", "zstd").saveAsTable(table)
    props = {"vigil.sort_keys": ",".join(sort_keys), "vigil.files": str(n)}
    if build_id:
        props["vigil.build_id"] = build_id
    kv = ", ".join(f"'{k}' = '{v}'" for k, v in props.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({kv})")


def layout_evidence(spark, table: str) -> DataFrame:
    """The layout read from the table itself, not the session conf."""
    return spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key").startswith("vigil."))


def _fs(spark, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _versions(spark, path: str) -> list[int]:
    """Published versions, oldest first: the names of the pointer files."""
    fs, p = _fs(spark, f"{path}/_published")
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(p) if f.getPath().getName().isdigit()) if fs.exists(p) else []


def _pointer(spark, path: str, version: int) -> dict:
    fs, p = _fs(spark, f"{path}/_published/{version:020d}")
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def publish_set(tables: dict[str, DataFrame], path: str, key_columns: dict[str, list[str]] | None = None) -> int:
    """Write a version of several tables and arm them together: each into a folder of its own under a name no other writer
    has, then one pointer that names all folders. If any of them fails, readers stay on the last version. Of two writers
    of the same version, the one whose pointer comes first wins; the other gets an error and disturbs nothing."""
    if not tables:
        raise ValueError("no tables to publish")
    spark = next(iter(tables.values())).sparkSession
    version = (_versions(spark, path) or [-1])[-1] + 1
    build, entries = uuid.uuid4().hex[:12], {}
    for name, df in tables.items():
        folder = f"build={build}/{name}"
        df.write.option("compression", "zstd").parquet(f"{path}/{folder}")
        fs, done = _fs(spark, f"{path}/{folder}/_SUCCESS")
        if not fs.exists(done):
            raise RuntimeError(f"{path}/{folder} was not committed")
        entries[name] = {"folder": folder, "keyColumns": (key_columns or {}).get(name, []), "schema": df.schema.jsonValue()}
    fs, tmp = _fs(spark, f"{path}/_published/_{build}")
    out = fs.create(tmp, False)
    out.write(bytearray(json.dumps({"version": version, "tables": entries}).encode()))
    out.close()
    _, pointer = _fs(spark, f"{path}/_published/{version:020d}")
    if fs.exists(pointer) or not fs.rename(tmp, pointer):  # a rename replaces nothing
        fs.delete(tmp, False)
        raise RuntimeError(f"version {version} of {path} has been published by another writer")
    return version


def read_set(spark, path: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of the last armed version, or of an older one."""
    versions = _versions(spark, path)
    if not versions:
        raise RuntimeError(f"{path} is not armed")
    entries = _pointer(spark, path, versions[-1] if version is None else version)["tables"]
    return {name: spark.read.schema(T.StructType.fromJson(e["schema"])).parquet(f"{path}/{e['folder']}") for name, e in entries.items()}


def publish(df: DataFrame, path: str, key_columns: list[str]) -> int:
    """``publish_set`` of one table. Returns the version."""
    return publish_set({"table": df}, path, {"table": key_columns})


def read_published(spark, path: str) -> DataFrame:
    """The last armed version."""
    return read_set(spark, path)["table"]


def write_evidence(metrics: DataFrame, path: str) -> None:
    """Run evidence (a small tall metrics frame) as one JSON file."""
    metrics.coalesce(1).write.mode("overwrite").json(path)
