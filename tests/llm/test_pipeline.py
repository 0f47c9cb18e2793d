"""The corpus pipeline against plain versions of its stages, each on what the stage before has kept."""

import corpus_pipeline
import numpy as np
import pyarrow.parquet as pq
from keyloom.llm import quality_crf
from pyspark.sql import functions as F

from . import plain
from .test_shingles import similar

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["quality", "lines", "near_duplicates", "benchmark", "tokens"]
    rows = lambda df: {r.doc_id: r.text for r in df.collect()}

    model = quality_crf.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    now = stage["quality"](spark, docs, SF)
    assert now.columns == columns
    scores = {r.doc_id: r.score for r in quality_crf.classify(docs, model).collect()}
    assert rows(now) == {i: t for i, t in rows(docs).items() if scores[i] >= 0.5}
    labelled = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    assert np.mean([(scores[i] >= 0.5) == q for i, q in labelled.items()]) > 0.95

    before, now = rows(now), stage["lines"](spark, now, SF)
    assert now.columns == columns and now.schema == docs.schema
    gone = {i: {int(p) for p in x.split(",") if p} for i, *_, x in plain.repeated_lines(list(before.items()))}
    assert rows(now) == {i: "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone[i]) for i, t in before.items()}

    before, now = rows(now), stage["near_duplicates"](spark, now, SF)
    assert now.columns == columns
    assert rows(now) == {i: before[i] for i, c in similar(list(before.items())) if c == i}

    before, now = rows(now), stage["benchmark"](spark, now, SF)
    assert now.columns == columns
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    assert rows(now) == {r[0]: before[r[0]] for r in plain.decontaminated(list(before.items()), items) if not r[5]}

    before, now = rows(now), stage["tokens"](spark, now, SF)
    assert rows(now) == before
    want = {r[0]: r[1:3] for r in plain.byte_bpe(list(before.items()))}
    assert {r.doc_id: (r.n_tokens, plain.sha(",".join(map(str, r.ids)).encode())) for r in now.collect()} == want

    assert {r.doc_id: r.text for r in corpus_pipeline.run(spark, SF).collect()} == before


def test_stages_take_awkward_rows(spark):
    rows = spark.createDataFrame(plain.ROWS, "doc_id bigint, text string")
    docs = rows.select("doc_id", "text", *[F.lit(c).alias(c) for c in plain.CLASHES], F.length("text").cast("bigint").alias("n_chars"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "tokens":
            assert out.columns == docs.columns
        assert out.count() <= len(plain.ROWS)
        assert stage(spark, docs.limit(0), SF).count() == 0
