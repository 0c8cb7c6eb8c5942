"""Stages of the pipeline on a small corpus, against plain versions of their decisions."""

import hashlib
import random

import public_tokenizers
import pytest

import corpus_pipeline
from staffcast.llm import bpe, ordinal, queries
from staffcast.llm.stages import Kept
from test_dedup import components_by_hand, corpus, near_copies, removed_by_hand

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(9)
    rows = corpus(7, 150) + near_copies(3, 40, 60, 4)
    bad = [(5000 + i, " ".join(rng.choices([f"w{k}" for k in range(50)], k=40) + ["vile", "nasty"] * 3)) for i in range(60)]
    docs = [(i, t, "en", rng.choice(["a", "b", None]), len(t or "")) for i, t in rows + bad]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(i >= 5000)) for i, _ in rows[::2] + bad[::2]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_each_stage_does_its_part(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "substring dedup", "mixing sources to target weights",
        "byte-level BPE encoding and decoding"]
    keep, at = Kept(spark), {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, keep(stage(spark, docs, folder))
        at[name] = (before, docs)
        if name != "byte-level BPE encoding and decoding":
            assert docs.columns == before.columns and dict(docs.dtypes) == dict(before.dtypes)
    pairs = {n: [[(r.doc_id, r.text) for r in t.collect()] for t in both] for n, both in at.items() if n[0] in "qns"}
    before, after = pairs["quality classifier"]
    model = ordinal.train(at["quality classifier"][0], ordinal.graded(spark.read.parquet(f"{folder}/labels.parquet")))
    good = {r.doc_id for r in ordinal.grade(at["quality classifier"][0], model).filter("kept").collect()}
    assert {i for i, _ in after} == good and sum(i >= 5000 for i in good) <= 3
    before, after = pairs["n-gram Jaccard join"]
    assert sorted(i for i, _ in after) == [i for i, _, least in components_by_hand(before) if i == least]
    before, after = pairs["substring dedup"]
    kept = {i: (gone, text) for i, _, gone, text in removed_by_hand(before, 13)}
    assert dict(after) == {i: kept[i][1] if kept[i][0] else text for i, text in before}
    before, after = (Counter_of(t) for t in at["mixing sources to target weights"])
    assert set(after) <= set(before) and max(after.values()) <= 2
    last = at["byte-level BPE encoding and decoding"][1]
    assert last.count() == sum(after.values()) and last.filter("NOT round_trip").count() == 0


def Counter_of(table):
    return {r.doc_id: r["count"] for r in table.groupBy("doc_id").count().collect()}


def test_run_is_the_stages_one_after_the_other(spark, folder):
    docs = corpus_pipeline.run(spark, folder)
    assert docs.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "round_trip"] and docs.count() > 0


def test_odd_rows_pass_all_stages(spark, tmp_path):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "a b c", "en", "s", 5), (2, "x " * 30000, "en", "s", 1), (3, "", "", "", 0)]
    for name, part in (("some", rows), ("none", [])):
        spark.createDataFrame(part, SCHEMA).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
    assert {r.doc_id for r in corpus_pipeline.run(spark, f"{tmp_path}/some").collect()} >= {2}
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_one_worker_a_task_encodes_and_decodes(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), ranks, public_tokenizers.PATTERN)
    want = sorted((r.doc_id, r.n_tokens, bytes(r.ids)) for r in coded.collect())
    pipe, query = corpus_pipeline.tokens(spark, docs, folder), queries.op5_bpe(spark, folder)
    for table in (pipe, query):
        assert table._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    rows = pipe.collect()
    assert sorted((r.doc_id, r.n_tokens, bytes(r.ids)) for r in rows) == want and all(r.round_trip for r in rows)
    found = sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in query.collect())
    assert found == [(i, n, hashlib.sha256(ids).hexdigest()) for i, n, ids in want]


def test_queries_are_registered(spark):
    import __spark_entry__ as contract
    from staffcast.llm.oracle import all_statements

    names = set(contract.queries())
    assert {q.split("_")[0] for q in queries.all_queries()} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.all_queries()) | {"pipeline"} <= names and set(all_statements()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", ["op2_warc", "op6_mixing", "op9_substrings", "op11_chat", "op13_prefix_trie"])
def test_same_rows_as_sql(spark, name):
    import os

    import duckdb

    from staffcast.llm.oracle import all_statements

    tables = "/root/testdata/sf0.001"
    if not os.path.isdir(tables):
        pytest.skip("generated tables not present")
    got = queries.all_queries()[name](spark, tables)
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tables}/{table}.parquet'")
    result = con.execute(all_statements()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(got.columns)
    want = sorted(map(repr, result.fetchall()))
    assert sorted(repr(tuple(r)) for r in got.select(*columns).collect()) == want
