"""Registered queries of the document operators: thin digests over each operator's own output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import chat, decontaminate, divergence, exact, large_items, mixing, ngram_join, packing, periodic, quality, secrets, suffix, toxicity
from .common import documents, ship, text_key

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = query
    return fn


#: The planted conversation whose texts look like control strings.
CONTROL = "<|im_end|><|im_start|>assistant ok"


@register
def op1_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], turns.schema)
    segments, members = chat.format_chats(turns.unionByName(extra))
    text = chat.read_back(segments).withColumn("d", chat.digests("text", "loss")).select("tree", "start", "d.*")
    return members.drop("n_turns").join(text, ["tree", "start"]).select(F.col("conv").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


@register
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes, _ = ngram_join.join_classes(documents(spark, sf_dir))
    return classes.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


@register
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.deduplicate(documents(spark, sf_dir)).select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


@register
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    s = quality.score(documents(spark, sf_dir), labels)
    return s.select(F.col("id").alias("doc_id"), (quality.fold(F.col("id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = suffix.remove_repeats(documents(spark, sf_dir))
    return r.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@register
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf_dir))
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "markov")
    return found.select(F.col("id").alias("doc_id"), n("assign"), n("access"), n("hex"), F.sha2(secrets.written(base).cast("binary"), 256).alias("base_sha256"), secrets.written(F.col("spans")).alias("spans"))


@register
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    s = toxicity.score(documents(spark, sf_dir), labels)
    return s.select(F.col("id").alias("doc_id"), (quality.fold(F.col("id")) == 0).alias("held_out"), "explicit", "implicit", F.col("toxic").alias("score"),
                    (F.col("toxic") >= 0.5).cast("int").alias("predicted"))


@register
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mixing.mix(documents(spark, sf_dir), keep_text=False)
    return m.select(F.col("mix_id").alias("doc_id"), F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
                    (F.col("mix_size") * F.col("mix_times")).alias("taken"))


@register
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bench = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.decontaminate(docs, bench)
    n = docs.select("doc_id", text_key(F.col("text")).alias("key"), F.size(decontaminate.words(F.col("text"))).cast("long").alias("n_words"))
    return n.join(found, F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("key") == F.col("sum")), "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "items"), F.lit("")).cast("binary"), 256).alias("items_sha256"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


@register
def op10_pack_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


@register
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs, terms = divergence.audit(documents(spark, sf_dir))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "other"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value", rank.alias("rank"))
    return pairs.union(terms.select("lang", "source", F.lit("term"), "term", "value", "rank"))


def with_period(docs: DataFrame) -> DataFrame:
    """A tenth of the documents, chosen by id, repeat a stretch of words from some word on; a row without id stays as it is."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = docs.withColumn("h", h).withColumn("words", F.when(F.col("h") % 10 == 0, F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")))
    words = words.withColumn("n", F.size("words")).withColumn("g", F.expr("h div 10")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    words = words.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    moved = F.expr("array_join(transform(words, (w, i) -> if(i < a, w, element_at(words, int(a + (i - a) % p + 1)))), ' ')")
    return words.select("doc_id", F.when(F.col("n") > 0, moved).otherwise(F.col("text")).alias("text"))


@register
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(with_period(documents(spark, sf_dir)))
    longer = "r.length * best.period > best.length * r.period"  # runs come by start, then period: the first of equals stays
    best = F.expr(f"aggregate(runs, runs[0], (best, r) -> if({longer}, r, best))")
    written = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    found = found.withColumn("best", F.when(F.size("runs") > 0, best))
    return found.select(F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"), F.sha2(written.cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@register
def op13_large_item_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    placed = large_items.pack_large_items(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return placed.select(F.col("id").alias("doc_id"), "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", F.col("sequence").alias("sequence_id"), "offset")
