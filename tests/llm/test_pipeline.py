"""The pipeline, stage by stage, and the registered queries against their SQL twins."""

import random
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from test_operators import SCHEMA, fingerprint, prose, rows
from tidegrid.llm import queries
from tidegrid.session import store

FOLDER = Path("/root/testdata/sf0.001")


def test_stages_on_awkward_rows(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, store(stage(spark, docs, "unused"), name)
        if name != "tokens":
            assert docs.columns == columns
        seen.append(docs.count())
        assert seen[-1] <= before.count()
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0
    assert seen[-1] == seen[-2]


def test_stages_on_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, "unused"), name)
        assert docs.count() == 0


def test_one_of_each_group_of_near_copies_stays(spark):
    """Against all pairs: texts link at three or fewer differing bits of their fingerprints, and links chain."""
    r = random.Random(3)
    texts = []
    for i in range(8):
        base = prose(700, 1000 + i).split(" ")
        texts.append(base)
        for _ in range(12):
            at = r.randrange(len(texts[-1]) - 1)
            texts.append([*texts[-1][:at], "changed", *texts[-1][at + 1 :]])
    texts = [" ".join(t) for t in texts] + [None, "", "?", " \t", prose(300, 1)]
    prints = [fingerprint(t, 3) for t in texts]
    least, before = list(range(len(texts))), None
    while least != before:
        before = list(least)
        for a in range(len(texts)):
            for b in range(a):
                if (prints[a] ^ prints[b]).bit_count() <= 3:
                    least[a] = least[b] = min(least[a], least[b])
    kept = {i for i, l in enumerate(least) if l == i}
    assert 10 < len(kept) < 60
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    assert sorted(row.doc_id for row in corpus_pipeline.distinct_enough(spark, docs, "").collect()) == sorted(kept)


needs_tables = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")


@needs_tables
def test_pipeline_is_registered(spark):
    found = entry.queries()["pipeline"](spark, str(FOLDER))
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(found.columns)
    assert 0 < found.count() <= spark.read.parquet(f"{FOLDER}/documents.parquet").count()


@needs_tables
@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_against_sql(spark, name):
    database = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        database.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    expected = database.execute(queries.ORACLES[name]).to_arrow_table()
    found = queries.QUERIES[name](spark, str(FOLDER)).toArrow()
    names = sorted(found.column_names)
    assert names == sorted(expected.column_names)
    table = lambda t: sorted(zip(*[map(repr, t[n].to_pylist()) for n in names]))
    assert table(found) == table(expected)


@needs_tables
@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLES])
def test_query_returns_all_rows(spark, name):
    found = queries.QUERIES[name](spark, str(FOLDER))
    source = "embeddings" if "vec_id" in found.columns else "documents"
    table = spark.read.parquet(f"{FOLDER}/{source}.parquet")
    ids = {r[0] for r in found.select("query_id" if source == "embeddings" else "doc_id").distinct().collect()}
    wanted = table.select("vec_id").filter("vec_id % 20 = 0") if source == "embeddings" else table.select("doc_id")
    assert ids == {r[0] for r in wanted.collect()}
    if source == "documents":
        assert found.count() == table.count()
