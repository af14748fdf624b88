"""The pipeline stage by stage against brute force, and the queries of the package."""

import os

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tests.llm import plain
from tremora.llm import toxicity

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    texts = plain.TEXTS + plain.long_texts()
    texts += [t + " moron scum trash" for t in texts[-20:] if len(t) < 1000]
    plain.documents(spark, texts, extra=False).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int("moron" in (t or ""))) for i, t in enumerate(texts)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    return folder, texts


def test_each_stage_against_brute_force(spark, tables):
    folder, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact dedup", "minhash near-dedup", "suffix-array dedup", "packing"]

    def after(number, before):
        out = corpus_pipeline.STAGES[number][1](spark, before, folder)
        assert number == 4 or out.columns == columns
        return spark.createDataFrame(out.collect(), out.schema)

    def pairs(df):
        return sorted((r.doc_id, r.text) for r in df.collect())
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    bad = {r.doc_id for r in toxicity.report(docs, model).where("predicted = 1").collect()}
    one = after(0, docs)
    assert pairs(one) == [p for p in pairs(docs) if p[0] not in bad]
    two, rows = after(1, one), pairs(one)
    want = plain.exact_groups([t for _, t in rows])
    assert pairs(two) == [rows[k] for k in sorted({w[0] for w in want})]
    three, rows = after(2, two), pairs(two)
    want = plain.near_groups([t for _, t in rows], 80)
    assert pairs(three) == [row for k, row in enumerate(rows) if want[k][1] == k]
    four, rows = after(3, three), pairs(three)
    cut = [w[3].decode(errors="ignore") for w in plain.repeats([t for _, t in rows], 255)]
    assert pairs(four) == [(i, None if t is None else c) for (i, t), c in zip(rows, cut)
                           if c or not t]
    five = after(4, four)
    assert {r.doc_id for r in five.collect()} == {i for i, _ in pairs(four)}


def test_the_whole_run_packs_what_is_left(spark, tables):
    folder, _ = tables
    out = corpus_pipeline.run(spark, folder)
    gaps = out.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m"))
    assert out.count() > 0 and gaps.where("n <> m").count() == 0


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="the generated tables are not here")
@pytest.mark.parametrize("name", ["op1_sentencepiece", "op2_toxicity", "op3_quality",
                                  "op6_packing", "op8_nearest"])
def test_queries_without_sql_give_rows_of_their_contract(spark, name):
    columns = {
        "op1": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
        "op2": {"doc_id", "held_out", "score", "predicted"},
        "op3": {"doc_id", "held_out", "score", "predicted"},
        "op6": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
        "op8": {"query_id", "rank", "vec_id", "score"}}[name[:3]]
    out = __spark_entry__.queries()[name](spark, SMALL)
    assert columns <= set(out.columns) and out.count() > 0
