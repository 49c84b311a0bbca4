"""The registered queries against DuckDB SQL, and the pipeline against a plain version of its stages."""
import duckdb
import pytest

from vigil.llm.oracle import ORACLE
from vigil.llm.queries import QUERIES

from .conftest import SF

TABLES = ("documents", "benchmark", "conversations", "labels")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_sql(spark, con, key):
    df = QUERIES[key](spark, SF)
    res = con.execute(ORACLE[key])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(df.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(names, res.fetchall())


def test_one_query_an_operator():
    assert [sum(k.startswith(f"op{n}_") for k in QUERIES) for n in range(1, 14)] == [1] * 13


def test_pipeline_stages(spark, con):
    import corpus_pipeline as p
    from vigil.llm import packing
    from vigil.llm.common import documents, materialize
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    docs = documents(spark, SF)
    good = materialize(p.quality_filter(spark, docs, SF), "good")
    scores = {r.doc_id: r.predicted for r in QUERIES["op4_quality"](spark, SF).collect()}
    assert ids(good) == sorted(i for i, x in scores.items() if x) and good.columns == docs.columns
    near = materialize(p.near_duplicates(spark, good, SF), "near")
    con.register("good_rows", good.toPandas())
    least = con.execute(ORACLE["op2_ngram_join"].replace("FROM documents", "FROM good_rows")).fetchall()
    assert ids(near) == sorted({r[2] for r in least})
    clean = materialize(p.without_benchmarks(spark, near, SF), "clean")
    con.register("near_rows", near.toPandas())
    hit = con.execute(ORACLE["op9_decontaminate"].replace("FROM documents", "FROM near_rows")).fetchall()
    assert ids(clean) == sorted(r[0] for r in hit if not r[5])
    mixed = materialize(p.mixed(spark, clean, SF), "mixed")
    con.register("clean_rows", clean.toPandas())
    taken = con.execute(ORACLE["op8_mix_sources"].replace("FROM documents", "FROM clean_rows")).fetchall()
    assert ids(mixed) == sorted(i for i, size, _, _, t in taken for _ in range(t // size if size else 0))
    assert mixed.columns == docs.columns
    rows = p.packed(spark, mixed, SF).collect()
    assert sorted(i for r in rows for i, k in zip(r.doc_ids, r.pieces) if k == 0) == ids(mixed)
    with open(packing.VOCABULARY, "rb") as f:
        t = packing.Tokenizer(f.read())
    assert sum(r.n_tokens for r in rows) == sum(len(t.own.encode_ordinary(r.text)) for r in mixed.collect())
    assert all(r.n_tokens <= packing.ROW_TOKENS and len(r.input_ids) == 2 * packing.ROW_TOKENS for r in rows)
