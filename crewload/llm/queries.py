"""One query per operator over the given tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, extract, hard_negatives, licenses, minhash, mixing, ngram_trie, packing, perplexity, quality
from . import repair, secrets


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_block_lstm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(_table(spark, sf_dir, "pages"))


def op2_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def op3_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_pairs(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_trie.score_texts(_table(spark, sf_dir, "documents"))


def op5_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_paths(chat.reply_chains(rows)))


def op6_perplexity_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.quality_rules(_table(spark, sf_dir, "documents"))


def op7_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def op8_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))
    base = ", ".join(f"'{k}'" for k in secrets.BASE_KINDS)
    joined = "array_join(transform({}, s -> concat(s.kind, ':', s.start, ':', s.`end`)), ',')"
    return found.select(
        "doc_id",
        *(F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in secrets.BASE_KINDS),
        F.sha2(F.expr(joined.format(f"filter(spans, s -> s.kind IN ({base}))")), 256).alias("base_sha256"),
        F.expr(joined.format("spans")).alias("spans"),
    )


def op10_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = lambda x: 256 * x.cast("double")
    whole = lambda x: F.when(F.abs(y(x)) < float(1 << 53), F.floor(y(x)).cast("double")).otherwise(y(x))
    rows = _table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END").alias("label"),
        F.transform("embedding", whole).alias("vec"),  # NaN and infinity stay what they are
    )
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)


def op12_exponential_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = mixing.word_count()
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), size, mixing.text_quality(size))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op13_audit_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damage(_table(spark, sf_dir, "conversations")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_block_lstm,
        op2_best_two_fit,
        op3_template_decontamination,
        op4_ngram_trie,
        op5_reply_trees,
        op6_perplexity_bands,
        op7_pu_quality,
        op8_license_index,
        op9_secret_scan,
        op10_circulant_minhash,
        op11_cover_tree,
        op12_exponential_mix,
        op13_audit_repair,
    )
}
