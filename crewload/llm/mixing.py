"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws an exponential key, -ln(u) / weight, with u from its id
and weight its quality: the documents of a source in key order are a weighted
sample without replacement of any length. A source's token budget is taken in
complete epochs (every document whole) first; what is left is a prefix of the
key order, found by a prefix sum, whose last document is cut to the budget.

Everything after the sizes is a few numbers per document. The prefix sum runs
over ranges of (source, key, ...), so a source that holds most documents is
many ranges, and the ranges are split inside copies of one row as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small, join_null_safe
from ..operators.ordered import dense_ids, running_sum
from ..session import stage

SEED = "mix-1"
SOURCE_WEIGHTS = (5, 2, 1)  # by place of the source, repeating
EPOCHS = 3  # most times a document is used
SYMBOLS = "#*$%&|<>"
LEAST_WEIGHT = 1e-6


def word_count(text: str = "text") -> Column:
    """Runs of other characters than space and \\x09-\\x0D; 0 for a null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def text_quality(size: Column, text: str = "text") -> Column:
    """A quality weight in (0, 1]: falls with the symbols per word."""
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return 1 / (1 + 4 * F.coalesce(symbols / F.nullif(size, F.lit(0)), F.lit(0.0)))


def exponential_key(doc_id: str = "doc_id", weight: str = "weight", seed: str = SEED) -> Column:
    """-ln(u) / weight; u in (0, 1) are 52 bits of a digest of seed and id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    w = F.when(F.isnan(weight) | (F.col(weight) == float("inf")), F.lit(None)).otherwise(F.col(weight))
    return -F.ln(u) / F.greatest(F.coalesce(w, F.lit(0.0)), F.lit(LEAST_WEIGHT))


def targets(sources: DataFrame, weights: Sequence[int] = SOURCE_WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """``sources`` (source, source_size) with the target of each.

    The sizes' total is shared by weight (sources by code point, null last,
    take the weights in turn); a target stops at ``epochs`` times its size and
    the excess is shared again until none is above. Each round is one
    aggregate: with sources capped, the share per weight only grows, so no
    capped source becomes free again.
    """
    placed = dense_ids(sources, ["source"], "place")
    turn = F.lit(list(weights))[F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int")]
    rows = stage(placed.select("source", "source_size", turn.cast("long").alias("w"), (F.col("source_size") * epochs).alias("cap")), "sources")
    total, weight = rows.agg(F.sum("source_size"), F.sum("w")).first()
    num, den, capped = int(total or 0), int(weight or 1), 0
    while True:
        over = F.col("w") * F.lit(num).cast("decimal(20,0)") > F.col("cap") * F.lit(den).cast("decimal(20,0)")
        n, taken, rest = rows.agg(F.count_if(over), F.sum(F.when(over, F.col("cap"))), F.sum(F.when(~over, F.col("w")))).first()
        if n == capped or rest is None:
            break
        num, den, capped = int(total) - int(taken), int(rest), n
    share = F.col("w") * F.lit(float(num)) / F.lit(float(den))
    return rows.select("source", "source_size", F.when(over, F.col("cap").cast("double")).otherwise(share).alias("target"))


def mix(docs: DataFrame, size: Column, weight: Column, weights: Sequence[int] = SOURCE_WEIGHTS, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, weight, source_size, target, taken) per row of
    ``docs`` (doc_id, source and what ``size`` and ``weight`` read).

    ``taken`` is the number of words the mix takes of the row, repeats
    counted, at most ``epochs`` times its size. Within a source the rows' sum
    is the target rounded to a whole word. The order is a function of the
    seed, id, weight and size alone, so reruns agree; rows alike in all of
    these and in source are interchangeable. A null or non-positive weight is
    the least weight; a null id is an id like any other; a null source is a
    source; empty texts and sources without words take 0.
    """
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"), weight.cast("double").alias("weight"))
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "sizes")
    sources = stage(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    place = F.col("source").asc_nulls_last()
    plan = running_sum(targets(sources, weights, epochs), [place], "source_size", "start")
    budget = F.floor(F.col("target") + 0.5).cast("long")
    whole = F.when(F.col("source_size") > 0, F.expr("int_budget div source_size")).otherwise(0)
    plan = plan.withColumn("int_budget", budget).withColumn("whole", whole)
    plan = stage(plan.withColumn("part", F.col("int_budget") - F.col("whole") * F.col("source_size")), "source-plan")

    order = [place, F.col("key"), F.col("doc_id").asc_nulls_last(), F.col("size"), F.col("weight"), F.col("row")]
    placed = running_sum(rows.withColumn("key", exponential_key(seed=seed)), order, "size")
    joined = join_null_safe(placed, broadcast_if_small(plan), ["source"])
    inside = F.col("part") - (F.col("before") - F.col("start"))
    taken = F.col("whole") * F.col("size") + F.greatest(F.lit(0), F.least(inside, F.col("size")))
    return joined.select("doc_id", "source", "size", "weight", "source_size", "target", taken.cast("long").alias("taken"))
