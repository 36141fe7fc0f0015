"""Documents to packed training sequences, one Spark job per stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet in the cluster's shared folder and read back as the next one's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crewload.llm import decontaminate, minhash, packing, quality, queries, secrets
from crewload.session import stage


PERCENT = 80  # least Jaccard similarity of near copies; 26 bands of 5 miss 3.3e-5 of the pairs at it


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be of quality 1. A document
    without any word goes too (nothing to learn from)."""
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.keep_quality(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, a
    similarity of ``PERCENT`` or more): that of the smallest id; of repeated rows of one id the first by text. Rows without an id stay."""
    groups = stage(minhash.near_duplicates(docs, percent=PERCENT), "groups")
    kept = groups.where("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi")
    first = F.min_by(F.struct(*named.columns), F.struct("text", *[c for c in named.columns if c != "text"]))
    once = named.groupBy("doc_id").agg(first.alias("row")).select("row.*")
    return once.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by a placeholder; ``n_chars`` is
    that of the new text."""
    out = secrets.redact_secrets(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return out


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces with their sequence and offset."""
    return packing.pack(docs, queries.tokenizer_path())


STAGES = [
    ("quality_classifier", quality_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scan", secrets_stage),
    ("best_fit_packing", packing_stage),
]

# Learnt scores, hashed signatures and token ids are beyond SQL; tests compare
# the stages with brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
