"""Registered queries: SQL where there is some, and the pipeline from end to end."""

import inspect
import os
import zlib
from collections import defaultdict

import duckdb
import pytest

import corpus_pipeline
from larder.llm.queries import ORACLE, QUERIES
from tests.llm.data import documents, prose, with_clashes

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "benchmark", "labels", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
    assert found == sorted(duck.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").fetchall(), key=str)


def test_all_are_registered():
    numbers = [int(name[2:].split("_")[0]) for name in QUERIES]
    assert numbers == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    assert all(list(inspect.signature(f).parameters) == ["spark", "docs", "sf_dir"] for _, f in corpus_pipeline.STAGES)


def test_pipeline_on_the_small_tables(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    pieces = corpus_pipeline.run(spark, SF_DIR).collect()
    lengths = defaultdict(int)
    for p in pieces:
        lengths[p["doc_id"]] += p["length"]
    assert all(lengths[p["doc_id"]] == p["doc_tokens"] for p in pieces)
    assert 0.7 * documents.count() < len(lengths) < documents.count()


def planted(tmp_path, spark):
    shared = "this line is repeated in many documents of the corpus"
    item = prose(9000, 40)
    rows = [(k, f"{prose(k, 80)}.\n{shared}\n{prose(k + 500, 40)}") for k in range(60)]
    rows += [(100 + k, f"{prose(k, 80)}. vilest {'rottened' if k % 2 else 'vilest'} one") for k in range(40)]
    rows += [(200, prose(3, 80) + ".\n" + prose(503, 40)), (201, f"{prose(800, 30)} {item} {prose(801, 20)}"), (202, None), (203, "")]
    labels = [(k, 0) for k in range(60)] + [(100 + k, 1) for k in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' lang", "'s' source", "char_length(text) n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return dict(rows), shared


def test_stages_take_effect(spark, tmp_path):
    rows, shared = planted(tmp_path, spark)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/out{k}")
        docs = spark.read.parquet(f"{tmp_path}/out{k}")
        if k < 4:
            assert docs.columns == columns
            kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    toxic, lines, near, clean = kept
    assert sum(i in toxic for i in range(100, 140)) <= 2 and all(i in toxic for i in [*range(60), 200, 201, 202, 203])
    assert set(lines) == set(toxic) and [i for i, t in lines.items() if t and shared in t] == [59]
    assert 200 not in near and 203 not in near and {*range(60), 201, 202} <= set(near)
    assert set(near) - set(clean) == {201}
    assert {r["doc_id"] for r in docs.collect()} == set(clean)


@pytest.mark.parametrize("k", range(5))
def test_stages_take_empty_tables_and_odd_columns(spark, tmp_path, k):
    planted(tmp_path, spark)
    stage = corpus_pipeline.STAGES[k][1]
    assert stage(spark, documents(spark, []), str(tmp_path)).count() == 0
    odd = with_clashes(documents(spark, [(1, "a b c"), (None, None), (2, ""), (2, ""), (3, prose(1, 5000))]))
    found = stage(spark, odd, str(tmp_path))
    assert found.count() >= 4 - (k == 2)
    if k < 4:
        assert found.columns == odd.columns


def test_packed_ids_of_kept_documents(spark, tmp_path):
    from larder.llm import packing
    from larder.llm.queries import token_file

    encode = packing.encoder(token_file())
    assert zlib.crc32(bytes(4)) == next(iter(packing.packed(documents(spark, [(1, None)]), token_file()).collect()))["ids_crc32"]
    assert encode("") == []
