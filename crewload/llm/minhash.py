"""Near-duplicate classes by circulant MinHash.

One permutation of the 64-bit shingle universe (``sigma``, the mixed shingle
hash) scatters a text's shingles; a second one (``pi``, the bijection
``mix64``), circularly shifted by k, gives signature coordinate k:
``min over x of pi(sigma(x) - k mod 2^64)``. Two permutations so serve all
``bands * rows`` coordinates. Rows of a band are hashed into a bucket key;
texts that share a bucket are candidates, and a candidate pair becomes a link
only after the exact Jaccard test on the full shingle sets.

With 26 bands of 5 rows a pair at similarity 0.85 misses every bucket with
probability (1 - 0.85^5)^26 = 2.4e-7 (at 0.9: 2e-10).

Skew: texts with equal shingle sets are one class from the start (a map-side
combined ``min``), only class representatives enter buckets, and a bucket is
compared against a few hubs per round instead of pairwise. Shingles that no
other candidate holds bound every intersection from above, which takes far
members out of a bucket before any comparison. A bucket leaves the loop once
all its members are in one component or have been compared, so no link
between different texts is lost and no bucket is capped.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small
from ..session import stage
from .words import NON_SPACE, U64, blocks, mix64, windows, words

SHINGLE, BANDS, ROWS, PERCENT = 5, 26, 5, 85
HUBS = 64  # members per bucket and round that are compared with the whole bucket
BROADCAST_BYTES = 32 << 20  # measured; beyond it, a shuffle join
_CHUNK = 1 << 15


def _shingle_sets(block, n: int):
    """Distinct shingle hashes of each text, sorted by (text, hash)."""
    w = words(block, NON_SPACE)
    h, doc, _ = windows(w, n)
    short = np.flatnonzero((w.count > 0) & (w.count < n))
    if len(short):  # fewer words than a shingle: the whole sequence is one
        extra = np.zeros(len(short), U64)
        for j in range(n - 1):
            has = w.count[short] > j
            extra[has] = mix64(extra[has] * U64(3) + w.hash[w.first[short[has]] + j])
        extra = mix64(extra + w.count[short].astype(U64))
        h, doc = np.concatenate([h, extra]), np.concatenate([doc, short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.bincount(doc, minlength=len(block)).astype(np.int64)


def _signatures(h: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Coordinates 0..k-1 of every non-empty set (``first``: set starts)."""
    out = np.full((len(first), k), np.iinfo(np.uint64).max, U64)
    cuts = [0]
    while cuts[-1] < len(h):  # cache-sized chunks of the joined sets
        cuts.append(min(len(h), cuts[-1] + _CHUNK))
    sigma = mix64(h ^ U64(0x5851F42D4C957F2D))
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        a, b = np.searchsorted(first, lo, "right") - 1, np.searchsorted(first, hi, "left")
        starts = np.maximum(first[a:b] - lo, 0)
        part = sigma[lo:hi]
        for j in range(k):
            x = part - U64(j)
            x ^= x >> U64(32)
            x *= U64(0xD6E8FEB86659FD93)
            x ^= x >> U64(32)
            x *= U64(0xD6E8FEB86659FD93)
            np.minimum(out[a:b, j], np.minimum.reduceat(x, starts), out=out[a:b, j])
    return out


def _sketch(n, bands, rows):
    def run(batches):
        for block in blocks(batches, "text"):
            h, count = _shingle_sets(block, n)
            full = np.flatnonzero(count)
            first = (np.cumsum(count) - count)[full]
            sig = _signatures(h, first, bands * rows)
            keys = np.zeros((len(full), bands), U64)
            for b in range(bands):
                acc = np.full(len(full), b + 1, U64)
                for r in range(rows):
                    acc = mix64(acc * U64(3) + sig[:, b * rows + r])
                keys[:, b] = acc
            whole = np.zeros((len(block), 2), U64)
            if len(full):
                whole[full, 0] = np.add.reduceat(mix64(h), first)
                whole[full, 1] = np.add.reduceat(mix64(h + U64(1)), first)
            at = np.zeros(len(block) + 1, np.int32)
            at[1:] = np.cumsum(np.where(count > 0, bands, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    block.batch.column(0),
                    pa.array(count),
                    pa.array(whole[:, 0].view(np.int64)),
                    pa.array(whole[:, 1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(keys.reshape(-1).view(np.int64))),
                ],
                ["doc_id", "n_shingles", "fp1", "fp2", "bands"],
            )

    return run


def _sets(n):
    def run(batches):
        for block in blocks(batches, "text"):
            h, count = _shingle_sets(block, n)
            at = np.zeros(len(block) + 1, np.int32)
            at[1:] = np.cumsum(count)
            yield pa.RecordBatch.from_arrays(
                [block.batch.column(0), pa.ListArray.from_arrays(pa.array(at), pa.array(h.view(np.int64)))],
                ["rep", "shingles"],
            )

    return run


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable over undirected links (a, b).

    Label propagation with pointer jumping: each round takes the smallest
    label of a node's neighbours, then the label's own label, so paths halve
    instead of shrinking by one edge. Each round is a written table.
    """
    edges = stage(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges"
    )
    label = stage(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "label")
    while True:
        near = (
            edges.join(label, edges.b == label.node)
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("comp").alias("near"))
        )
        step = label.join(near, "node").select("node", "comp", F.least("comp", "near").alias("next"))
        jump = label.select(F.col("node").alias("next"), F.col("comp").alias("far"))
        step = step.join(jump, "next", "left").select(
            "node", F.col("comp").alias("old"), F.least("next", F.coalesce("far", "next")).alias("comp")
        )
        step = stage(step, "label")
        label = step.select("node", "comp")
        if step.where("old <> comp").isEmpty():
            return label


def _common(sets: DataFrame) -> DataFrame:
    """(rep, size, common): a set's size and how many of its shingles are in
    another candidate's set too. No intersection can be larger."""
    size = sets.select("rep", F.size("shingles").cast("long").alias("size"))
    own = sets.select("rep", F.explode("shingles").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("rep"))
    own = own.where("n = 1").groupBy("rep").agg(F.count(F.lit(1)).alias("own"))
    out = size.join(own, "rep", "left").withColumn("common", F.col("size") - F.coalesce("own", F.lit(0)))
    return out.groupBy("rep").agg(F.min("size").alias("size"), F.max("common").alias("common"))


def _reachable(members: DataFrame, percent: int) -> DataFrame:
    """Bucket members (key, rep, size, common, bands, comp, main) that may still gain
    a link inside their bucket. A set whose common shingles are too few for a
    link even with the bucket's smallest set leaves; so does a bucket whose
    members are all in one component. ``main`` is its largest component."""
    least = members.groupBy("key").agg(F.min("size").alias("least"))
    near = members.join(least, "key").where(
        (F.col("common") * 100 >= percent * F.col("size")) & ((100 + percent) * F.col("common") >= percent * (F.col("size") + F.col("least")))
    )
    size = near.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("m"))
    several = size.groupBy("key").agg(F.max(F.struct("m", "comp")).alias("top"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    return near.join(several.select("key", F.col("top.comp").alias("main")), "key").select(
        "key", "rep", "size", "common", "bands", "comp", "main"
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"))
    same = F.size(F.array_intersect("sa", "sb"))
    small, large = F.least(F.size("sa"), F.size("sb")), F.greatest(F.size("sa"), F.size("sb"))
    both = pairs.join(right, "b").join(left, "a").where(100 * small >= percent * large)
    return both.where(100 * same >= percent * (F.size("sa") + F.size("sb") - same)).select("a", "b")


def _same_id(full: DataFrame, classes: DataFrame, label: DataFrame | None) -> DataFrame | None:
    """``label`` with the classes of one doc_id linked: an id whose rows have
    different texts is one node, in all its classes."""
    key = ["fp1", "fp2", "n_shingles"]
    least, most = (f(F.struct(*key)) for f in (F.min, F.max))
    several = stage(full.groupBy("doc_id").agg(least.alias("lo"), most.alias("hi")).where("lo <> hi").select("doc_id"), "several")
    if several.isEmpty():
        return label
    seen = full.join(broadcast_if_small(several, BROADCAST_BYTES), "doc_id", "left_semi").select("doc_id", *key).distinct()
    seen = stage(seen.join(classes.select(*key, "rep"), key).select("doc_id", "rep"), "same-id")
    first = seen.groupBy("doc_id").agg(F.min("rep").alias("a"))
    links = seen.join(first, "doc_id").select("a", F.col("rep").alias("b")).where("a <> b")
    if label is not None:
        links = links.union(label.where("node <> comp").select("node", "comp"))
    return components(links)


def near_duplicates(
    docs: DataFrame, n: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    ``docs`` needs doc_id and text; other columns are ignored. Words are runs
    of non-white-space with A-Z lower-cased. A null or empty text has an empty
    set and is linked with nothing; a text of fewer than ``n`` words has one
    shingle. Rows with equal sets are linked, and so are the rows of one
    doc_id, whatever their texts; repeated rows give repeated result rows. A null doc_id is linked with nothing: component_id null,
    kept true. An empty table gives no rows.
    """
    flat = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sketch = stage(
        flat.mapInArrow(
            _sketch(n, bands, rows), "doc_id long, n_shingles long, fp1 long, fp2 long, bands array<long>"
        ),
        "sketch",
    )
    full = sketch.where("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy("fp1", "fp2", "n_shingles").agg(
        F.min("doc_id").alias("rep"), F.min_by("bands", "doc_id").alias("bands")
    )
    classes = stage(classes, "classes")
    rows_ = classes.select("rep", F.explode("bands").alias("key"))
    shared = rows_.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    members = stage(rows_.join(shared.select("key"), "key"), "members")
    wanted = broadcast_if_small(stage(members.select("rep").distinct(), "wanted"), BROADCAST_BYTES)
    texts = flat.join(wanted, flat.doc_id == wanted.rep, "left_semi")
    sets = stage(texts.mapInArrow(_sets(n), "rep long, shingles array<long>").dropDuplicates(["rep", "shingles"]), "sets")
    members = members.join(_common(sets), "rep").join(classes.select("rep", "bands"), "rep")
    members = stage(members, "members")

    open_ = _reachable(members.withColumn("comp", F.col("rep")), percent)
    members = stage(open_, "open")
    done, label = [], None
    while not members.isEmpty():
        # hubs: outside their bucket's largest component, those with the fewest shingles of their own first
        rank = F.row_number().over(Window.partitionBy("key").orderBy((F.col("common") / F.col("size")).desc(), "rep"))
        hubs = members.where("comp <> main" if done else "true").withColumn("nth", rank).where(F.col("nth") <= (HUBS if done else 1))
        hubs = stage(hubs.select("key", *[F.col(c).alias(f"hub_{c}") for c in ("rep", "size", "common", "comp", "bands")]), "hubs")
        bound = (100 + percent) * F.least("common", "hub_common") >= percent * (F.col("size") + F.col("hub_size"))
        once = F.expr("element_at(array_intersect(hub_bands, bands), 1) = key")  # a pair's first shared bucket
        tried = hubs.join(members, "key").where((F.col("hub_comp") != F.col("comp")) & bound & (F.col("hub_rep") != F.col("rep")) & once)
        pairs = tried.select(F.least("hub_rep", "rep").alias("a"), F.greatest("hub_rep", "rep").alias("b")).distinct()
        if done:
            pairs = pairs.join(reduce(DataFrame.union, done), ["a", "b"], "left_anti")
        pairs = stage(pairs, "pairs")
        done.append(pairs)
        found = _verified(pairs, sets, percent)
        if label is not None:
            found = found.union(label.where("node <> comp").select("node", "comp"))
        label = components(found)
        # compared hubs leave their buckets
        left = members.join(hubs.select("key", F.col("hub_rep").alias("rep")), ["key", "rep"], "left_anti").drop("comp", "main")
        left = left.join(label.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
        members = stage(_reachable(left, percent), "open")

    label = _same_id(full, classes, label)
    reps = classes.select("fp1", "fp2", "n_shingles", "rep")
    if label is None:
        reps = reps.withColumn("comp", F.col("rep"))
    else:
        reps = reps.join(label.withColumnRenamed("node", "rep"), "rep", "left")
    reps = reps.select("fp1", "fp2", "n_shingles", F.coalesce("comp", "rep").alias("component_id"))
    linked = full.select("doc_id", "fp1", "fp2", "n_shingles").join(reps, ["fp1", "fp2", "n_shingles"])
    alone = sketch.where("n_shingles = 0 or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    out = linked.select("doc_id", "n_shingles", "component_id").unionByName(alone)
    # rows of one doc_id with different texts: the id is one node of the graph
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
