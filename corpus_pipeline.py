"""The text pipeline: identify, join near copies, decontaminate, mask, mix.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes a
stage's result as Parquet and reads it back as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayloom.llm import decontaminate, jaccard, lang_id, mixing, pii
from wayloom.llm.common import SPACE, stored
from wayloom.session import ship

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
MIN_SCORE = 0.2


def least_score(classes: int) -> float:
    """The score to exceed: ``MIN_SCORE`` of the way from chance to certainty; one class alone rejects nothing."""
    return 1 / classes + MIN_SCORE * (1 - 1 / classes) if classes > 1 else 0.0


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID (8): documents without letters, or with a score of ``least_score`` or less, go.

    The network is fitted on a bounded sample of the labelled documents of the stage's input.
    """
    model = lang_id.fit(docs)
    found = lang_id.identify(docs.select(*COLUMNS), model, "text")
    least = least_score(len(model["langs"]) if model else 1)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") > least)).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (6): of every component the document with the smallest doc_id stays.

    A null doc_id comes last. Of repeated rows (same doc_id and text) one stays;
    documents without words are linked with nothing and all stay.
    """
    found = jaccard.near_duplicates(docs)
    first = found.where("n_shingles > 0").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "id")).alias("m"))
    best = first.select("m.doc_id", "m.id")
    rows = docs.select(*COLUMNS).withColumn("id", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    same = F.col("r.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("r.id") == F.col("b.id"))
    kept = rows.alias("r").join(best.alias("b"), same, "left_semi")
    blank = rows.where(~F.coalesce(F.col("text"), F.lit("")).rlike(f"[^{SPACE}]"))
    once = kept.groupBy("doc_id", "id").count().where("count > 1")
    if not once.isEmpty():
        kept = kept.dropDuplicates(["doc_id", "id"])
    return kept.union(blank).select(*COLUMNS)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (2): documents that hold a benchmark item go."""
    docs = docs.select(*COLUMNS)
    marked = docs.withColumn("text_id", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    hit = decontaminate.contaminated(marked, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), key="text_id")
    return marked.join(hit.select(F.col("doc_id").alias("text_id")).distinct(), "text_id", "left_anti").select(*COLUMNS)


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII (1): every span is replaced by its kind; all documents stay, n_chars follows the text."""
    out = pii.tagged(docs.select(*COLUMNS), pii.fit(docs), rewrite=True)
    text = F.coalesce(F.col("_pii.clean"), F.col("text"))
    n = F.when(F.col("_pii.clean").isNotNull(), F.length("_pii.clean").cast("long")).otherwise(F.col("n_chars"))
    return out.select("doc_id", text.alias("text"), "lang", "source", n.alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing (10): the words that the mix takes of each document."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", keep_languages),
    ("jaccard_join", keep_one_of_each),
    ("decontaminate", remove_benchmark),
    ("pii", mask_personal),
    ("mix", mix_sources),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
