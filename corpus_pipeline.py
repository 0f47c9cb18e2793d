"""The corpus pipeline: each stage takes the documents that the stage before it has kept, and is written as
Parquet and read again before the next one. Every stage but the last returns the columns of documents."""

from __future__ import annotations

from collections.abc import Callable

from keyloom.llm import bpe, common, decontaminate, line_dedup, quality_crf, simhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _packed(docs: DataFrame) -> DataFrame:
    """Each row as a struct beside its id and a hash of its text, so that no column's name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("own"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"))


def _name(own: Column) -> Column:
    """An id as a string that is never null, so that a join by it and what follows share one shuffle."""
    return F.coalesce(F.concat(F.lit("="), own.cast("string")), F.lit(""))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier, fitted on labelled ones, predicts to be good. A null or empty text is
    scored as one empty line; repeated rows share their fate; an empty table stays empty."""
    model = quality_crf.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    common.bounded_batches(spark)
    return docs.filter(quality_crf.quality_score(model) >= 0.5)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier one equals or, within the edits of line_dedup.EDITS, nearly
    equals; n_chars follows the text. Null and empty texts stay as they are; repeated rows lose the same lines."""
    kept = line_dedup.without_repeated_lines(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of texts that share 0.8 or more of their five-word
    shingles (Jaccard, confirmed on whole sets; pairs beyond a SimHash radius are not compared, which loses a link
    with a chance of some 1 in 10^5 or less); of rows with that id, the one with the smallest hash of its text. A group of null
    ids alone keeps one row of each text."""
    groups = simhash.similar_groups(docs, words=5, similarity=0.8)
    kept = groups.filter("doc_id <=> component_id and (tie = component_tie or doc_id is null)").select(_name(F.col("doc_id")).alias("name"), "tie").distinct()
    rows = _packed(docs).withColumn("name", _name(F.col("own"))).join(kept, ["name", "tie"], "left_semi")
    return rows.dropDuplicates(["name", "tie"]).select("row.*")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of ten words with a benchmark item. Null, empty and wordless texts share
    none; repeated rows share their fate; without items all documents stay."""
    hit = decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).filter("contaminated").select(F.col("doc_id").alias("id"), "tie").distinct()
    rows = _packed(docs).withColumnRenamed("tie", "own_tie")
    return rows.join(hit, F.col("own").eqNullSafe(F.col("id")) & (F.col("own_tie") == F.col("tie")), "left_anti").select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the text that the ids decode to, of every row; a null text is an empty one."""
    made = bpe.bpe_encode(docs)
    return made.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.decode("decoded", "UTF-8").alias("text"))


STAGES: list[tuple[str, Stage]] = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("tokens", tokens)]

#: SQL cannot express the classifier, the edit join or the set join; tests compare with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    top = common.shared_dir(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{top}/{k}-{name}")
        docs = spark.read.parquet(f"{top}/{k}-{name}")
    return docs
