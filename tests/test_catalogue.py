"""Every query of the catalogue against DuckDB on the smallest tables; those without SQL by what their rows must hold."""

import math

import duckdb
import pytest
from millrace.plans import catalogue, catalogue_files, catalogue_records, catalogue_runs, catalogue_streams, catalogue_tables, catalogue_times  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return str(v)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, sf, duck, name):
    df = catalogue.QUERIES[name](spark, sf)
    got = sorted(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    duck.execute(catalogue.ORACLES[name])
    rows, columns = duck.fetchall(), [c[0] for c in duck.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    assert sorted(df.columns) == sorted(columns)
    assert got == sorted(tuple(plain(r[i]) for i in order) for r in rows)
    assert got


def test_minhash_keeps_about_what_similarity_keeps(spark, sf):
    ids = lambda name: {r.doc_id for r in catalogue.QUERIES[name](spark, sf).collect()}
    exact, greedy, verified = ids("dedup_jaccard"), ids("dedup_minhash"), ids("dedup_minhash_verified")
    assert len(exact ^ greedy) <= 5 and exact <= verified


def test_index_keeps_what_one_run_keeps(spark, sf):
    ids = lambda name: sorted(r.doc_id for r in catalogue.QUERIES[name](spark, sf).collect())
    assert ids("index_minhash") == ids("dedup_minhash")


def test_decontamination_takes_rows(spark, sf):
    parts = catalogue.QUERIES["split_clean"](spark, "/root/testdata/sf0.01").groupBy("split").count().collect()
    assert 0 < sum(r["count"] for r in parts) < 1000


def test_plan_counts(spark, sf):
    r = catalogue.QUERIES["corpus_meta"](spark, sf).collect()[0]
    assert r.n_preprocessed >= r.n_filtered >= r.n_deduplicated >= r.n_train + r.n_val + r.n_test
    assert r.n_test == max(1, r.n_deduplicated // 100) and r.n_val == max(1, r.n_deduplicated * 2 // 100)
