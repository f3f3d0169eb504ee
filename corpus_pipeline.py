"""A training corpus from raw documents: five stages, each one operator over all that the last one kept.

Each stage is written as Parquet below the shared folder and read again. All but the last return the
columns of documents; a stage's decisions take effect: rejected, repeated and contaminated documents go,
personal data is masked. SQL can't express a stage, so ``ORACLE_SQL`` is None. The near-duplicates stage is
tested against planted copies, the operators of the other stages by themselves; the stages and ``run`` as such are not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweft.llm import copies, lsa, pieces, pii, rules
from eventweft.llm.common import scratch, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least the cut."""
    model = rules.quality_model(docs, table(spark, sf_dir, "labels"))
    return rules.scored(docs, model, "__score").filter(F.col("__score") >= rules.CUT).drop("__score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies, by SimHash and pivot tables with an
    exact check: five-word shingles, similarity 0.8."""
    return copies.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return lsa.clean(docs, table(spark, sf_dir, "benchmark"))


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text."""
    text = pii.masked(F.col("text"), pii.fit(docs))
    names = docs.columns
    out = docs.withColumn("text", text)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, and the text that the ids decode to."""
    coded = pieces.coded(docs, pieces.model_path(), ["doc_id"])
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.col("decoded").alias("text"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("privacy", privacy),
    ("tokens", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
