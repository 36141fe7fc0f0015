"""Hard negatives by a cover tree over norm-augmented candidates.

A candidate x gets one more coordinate, sqrt(M^2 - |x|^2), with M the largest
norm, and an anchor a zero there: inner products stay as they are, all
candidates lie on a sphere of radius M, and a covering radius becomes an
angle. With t the angle between an anchor and a node's centre and p the node's
angle, the inner products below the node lie in |q| M [cos(t + p), cos(t - p)].

The top of the tree is spread over Spark: pivots chosen on a bounded sample
divide all candidates into cells, a cell into shards of bounded size, and a
task builds each shard's tree: every node's points lie within its covering
radius, its children within half of it and more than that apart. An anchor
first descends the shards of its own cell, which gives a floor; then all other
shards whose bounds reach the floor (and a window). In a shard the descent is
best first: it stops when no node can hold a better candidate, skips nodes
outside all windows and scores leaves exactly. Shards and groups of anchors
are of bounded size, so a task's memory is, whatever the skew.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small
from ..session import stage

SAMPLE = 2048  # candidates that the pivots are chosen from, by a hash of the id
SHARD = 8192  # candidates in a tree
MOST_CELLS = 256
ANCHORS = 16384  # anchors in a task
LEAF = 32  # points of a node that is not divided
EXACT = float(1 << 53)  # products below it are exact in doubles
SLACK = 1e-6  # of |q| M, for rounding in the bounds


# --- the tree (numpy, inside tasks) ----------------------------------------


def augmented(x: np.ndarray, m2: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(m2 - np.einsum("ij,ij->i", x, x), 0.0))
    return np.concatenate([x, rest[:, None]], axis=1)


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a from all rows of b."""
    d = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :] - 2 * (a @ b.T)
    return np.maximum(d, 0.0)


def net(x: np.ndarray, first: int, radius: float, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Centres more than ``radius`` apart that cover all rows of ``x``, and
    the centre each row belongs to (by place in the list)."""
    owner = np.full(len(x), -1)
    centres = [first]
    r2 = radius * radius
    owner[_near(x, x[first : first + 1])[:, 0] <= r2] = 0
    owner[first] = 0
    left = np.flatnonzero(owner < 0)
    while len(left):
        some = left[:block]
        close = _near(x[some], x[some]) <= r2
        taken: list[int] = []
        for i in range(len(some)):  # greedy among the block
            if not close[i, taken].any():
                taken.append(i)
        chosen = some[taken]
        near = _near(x[left], x[chosen])
        at = near.argmin(axis=1)
        inside = near[np.arange(len(left)), at] <= r2
        owner[left[inside]] = len(centres) + at[inside]
        owner[chosen] = len(centres) + np.arange(len(chosen))
        centres.extend(chosen.tolist())
        left = left[owner[left] < 0]
    return np.asarray(centres), owner


def build_tree(ids: np.ndarray, labels: np.ndarray, x: np.ndarray, m2: float) -> dict:
    """The cover tree of a shard as flat arrays, children of a node in a row.

    ``own`` are the points that a node scores itself: all of a small node, the
    children of a larger one that hold no other point.
    """
    aug = augmented(x, m2)
    root = int(_near(aug, aug.mean(axis=0, keepdims=True))[:, 0].argmin())
    todo = [(np.arange(len(x)), root)]
    centre, radius, own, child = [], [], [], []
    made = 1
    for members, c in todo:  # grows: breadth first
        far = np.sqrt(_near(aug[members], aug[c : c + 1])[:, 0].max())
        centre.append(c)
        radius.append(far)
        if len(members) <= LEAF or far <= 1e-9 * np.sqrt(m2):
            own.append(members)
            child.append((made, made))
            continue
        centres, owner = net(aug[members], int(np.flatnonzero(members == c)[0]), far / 2)
        size = np.bincount(owner, minlength=len(centres))
        alone = size[owner] == 1
        own.append(members[alone])
        groups = np.flatnonzero(size > 1)
        order = np.argsort(owner, kind="stable")
        ends = np.cumsum(size)
        todo.extend((members[order[ends[g] - size[g] : ends[g]]], int(members[centres[g]])) for g in groups)
        child.append((made, made + len(groups)))
        made += len(groups)
    place = np.concatenate(own)
    ends = np.cumsum([len(o) for o in own])
    angle = 2 * np.arcsin(np.minimum(1.0, np.asarray(radius) / (2 * np.sqrt(m2)))) if m2 > 0 else np.zeros(len(radius))
    return {
        "x": x[place], "ids": ids[place], "labels": labels[place], "m2": m2,
        "centre": x[np.asarray(centre)], "angle": angle, "child": np.asarray(child), "own": np.concatenate([[0], ends]),
    }


def bounds(products: np.ndarray, norm: float, m2: float, angle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product below nodes with these centre products."""
    reach = norm * np.sqrt(m2)
    if reach <= 0:
        return np.zeros_like(products), np.zeros_like(products)
    theta = np.arccos(np.clip(products / reach, -1.0, 1.0))
    slack = SLACK * reach + SLACK
    return reach * np.cos(np.minimum(np.pi, theta + angle)) - slack, reach * np.cos(np.maximum(0.0, theta - angle)) + slack


def _scores(x: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        return x @ q
    return np.array([sum(int(a) * int(b) for a, b in zip(row, q, strict=True)) for row in x], dtype=object)


class Best:
    """The best ``k`` (score, id), larger scores and smaller ids first, of
    those within lo..hi; ``lo`` rises with the k-th."""

    def __init__(self, k: int, lo: float, hi: float):
        self.k, self.lo, self.hi = k, lo, hi
        self.found: list[tuple[int, int]] = []  # (-score, id)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        at = np.flatnonzero((scores >= self.lo) & (scores <= self.hi))
        if len(at) > self.k:  # the k-th and all that tie with it
            cut = np.partition(scores[at], len(at) - self.k)[len(at) - self.k]
            at = at[scores[at] >= cut]
        if len(at):
            merged = sorted([*self.found, *((-int(s), int(i)) for s, i in zip(scores[at], ids[at], strict=True))])
            self.found = merged[: self.k]
            if len(self.found) == self.k:
                self.lo = max(self.lo, -self.found[-1][0])


def descend(tree: dict, q: np.ndarray, wanted: list[Best], keep, products: np.ndarray, exact: bool) -> None:
    """Best-first descent for one anchor. ``keep(labels, ids)`` masks the
    points that may be offered; ``products`` are those with the centres."""
    low, high = bounds(products, float(np.sqrt(q @ q)), tree["m2"], tree["angle"])
    most = max(b.hi for b in wanted)
    heap = [(-min(high[0], most), 0)]
    while heap:
        first, node = heapq.heappop(heap)
        if -first < min(b.lo for b in wanted):
            break  # no node left reaches any floor
        if not any(high[node] >= b.lo and low[node] <= b.hi for b in wanted):
            continue
        lo, hi = tree["own"][node], tree["own"][node + 1]
        if hi > lo:
            mask = keep(tree["labels"][lo:hi], tree["ids"][lo:hi])
            scores, ids = _scores(tree["x"][lo:hi], q, exact)[mask], tree["ids"][lo:hi][mask]
            for b in wanted:
                b.offer(scores, ids)
        for c in range(*tree["child"][node]):
            if any(high[c] >= b.lo and low[c] <= b.hi for b in wanted):
                heapq.heappush(heap, (-min(high[c], most), c))


# --- Spark -------------------------------------------------------------------


def _matrix(col: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in col.chunks]) if col.num_chunks else pa.array([], pa.float64())
    return np.asarray(flat, dtype=np.float64).reshape(len(col), dim)


def candidates(rows: DataFrame) -> DataFrame:
    """(vec_id, label, vec, dim): rows with an id, a label and finite
    components only; of rows with one id the least by label and vector."""
    finite = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("vec").cast("array<double>"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & finite)
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("r"))
    return rows.select("vec_id", "r.label", "r.vec", F.size("r.vec").alias("dim"))


def choose_pivots(points: DataFrame, n: int, m2: float, shard: int, sample: int) -> dict[int, np.ndarray]:
    """Far-apart pivots by dimension, from the ``sample`` points of least
    id hash (the only rows that reach the driver)."""
    some = points.select("dim", "vec").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    by_dim: dict[int, list] = {}
    for r in some:
        by_dim.setdefault(r.dim, []).append(r.vec)
    out = {}
    cells = min(MOST_CELLS, -(-n // shard))
    for dim, vecs in by_dim.items():
        aug = augmented(np.asarray(vecs, float).reshape(len(vecs), dim), m2)
        chosen = [0]
        near = _near(aug, aug[:1])[:, 0]
        while len(chosen) < min(cells, len(aug)) and near.max() > 0:
            chosen.append(int(near.argmax()))
            near = np.minimum(near, _near(aug, aug[chosen[-1:]])[:, 0])
        out[dim] = aug[chosen]
    return out


def _cells(pivots: dict[int, np.ndarray], m2: float):
    """The nearest pivot of each point (-1 where its dimension has none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(b.schema.get_field_index("dim")).to_numpy()
            vec = b.column(b.schema.get_field_index("vec"))
            cell = np.full(len(dims), -1, np.int32)
            for dim in np.unique(dims):
                if int(dim) in pivots:
                    at = np.flatnonzero(dims == dim)
                    x = _matrix(pa.chunked_array([vec.take(pa.array(at))]), int(dim))
                    cell[at] = _near(augmented(x, m2), pivots[int(dim)]).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], names=[*b.schema.names, "cell"])

    return run


def _plant(m2: float):
    def run(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        x = _matrix(table.column("vec"), dim)
        order = np.argsort(ids := np.asarray(table.column("vec_id")))
        tree = build_tree(ids[order], np.asarray(table.column("label"))[order], x[order], m2)
        return pa.table(
            {
                "shard": table.column("shard").slice(0, 1), "dim": table.column("dim").slice(0, 1),
                "cell": table.column("cell").slice(0, 1), "centre": pa.array([tree["centre"][0].tolist()], pa.list_(pa.float64())),
                "angle": pa.array([float(tree["angle"][0])]), "tree": pa.array([pickle.dumps(tree, protocol=5)], pa.binary()),
            }
        )

    return run


def plant(celled: DataFrame, m2: float, shard: int) -> DataFrame:
    """One cover tree per shard: (shard, dim, cell, centre, angle, tree)."""
    ways = celled.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("ways"))
    salted = celled.join(broadcast_if_small(stage(ways, "cells")), ["dim", "cell"])
    salted = salted.withColumn("shard", F.concat_ws(":", "dim", "cell", F.pmod(F.xxhash64("vec_id", F.lit(7)), "ways")))
    trees = salted.select("shard", "dim", "cell", "vec_id", "label", "vec").groupBy("shard").applyInArrow(
        _plant(m2), "shard string, dim int, cell int, centre array<double>, angle double, tree binary"
    )
    return stage(trees, "trees")


WINDOWS = "array<struct<positive_id:bigint,positive_score:bigint,lo:bigint,hi:bigint>>"
FOUND = "anchor_id long, positive_id long, positive_score long, vec_id long, score long"


def _search(most: int, m2: float, same_label: bool):
    """One task: the tree of a shard and a bounded group of anchors."""
    exact = m2 < EXACT
    schema = pa.schema([(n, pa.int64()) for n in ("anchor_id", "positive_id", "positive_score", "vec_id", "score")])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(left) and len(right):
            tree = pickle.loads(left.column("tree")[0].as_py())
            q = _matrix(right.column("vec"), tree["x"].shape[1])
            ids, labels = right.column("anchor_id").to_pylist(), right.column("label").to_pylist()
            windows = right.column("windows").to_pylist()
            for lo in range(0, len(q), 256):
                products = q[lo : lo + 256] @ tree["centre"].T
                for i in range(lo, min(lo + 256, len(q))):
                    me, label = ids[i], labels[i]
                    wanted = [Best(most, w["lo"], w["hi"]) for w in windows[i]]
                    if same_label:
                        keep = lambda ls, vs: (ls == label) & (vs != me)  # noqa: B023, E731
                    else:
                        keep = lambda ls, vs: ls != label  # noqa: B023, E731
                    descend(tree, q[i], wanted, keep, products[i - lo], exact)
                    for w, b in zip(windows[i], wanted, strict=True):
                        out.extend((me, w["positive_id"], w["positive_score"], v, -s) for s, v in b.found)
        cols = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 5
        return pa.Table.from_arrays(cols, schema=schema)

    return run


def _visit(trees: DataFrame, anchors: DataFrame, own: bool, groups: int, most: int, m2: float, same_label: bool) -> DataFrame:
    """What anchors find in the shards of their own cell, or in the others
    whose bounds reach one of their windows."""
    roots = broadcast_if_small(trees.select("shard", "dim", F.col("cell").alias("root_cell"), "centre", "angle"))
    pairs = anchors.join(roots, "dim")
    if own:
        pairs = pairs.where(F.col("cell") == F.col("root_cell"))
    else:
        pairs = pairs.where(F.col("cell") != F.col("root_cell"))
        dot = F.aggregate(F.zip_with("vec", "centre", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        reach = F.col("norm") * float(np.sqrt(m2))
        theta = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.coalesce(F.try_divide(dot, reach), F.lit(0.0)))))
        slack = reach * SLACK + SLACK
        pairs = pairs.withColumn("__high", reach * F.cos(F.greatest(F.lit(0.0), theta - F.col("angle"))) + slack)
        pairs = pairs.withColumn("__low", reach * F.cos(F.least(F.lit(np.pi), theta + F.col("angle"))) - slack)
        pairs = pairs.where(F.exists("windows", lambda w: (F.col("__high") >= w["lo"]) & (F.col("__low") <= w["hi"])))
    group = F.pmod(F.xxhash64("anchor_id"), F.lit(groups)).cast("int")
    visits = pairs.select(F.col("shard").alias("visited"), group.alias("part"), "anchor_id", "label", "vec", "windows")
    shards = trees.select("shard", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"), "tree")
    return shards.groupBy("shard", "part").cogroup(visits.groupBy("visited", "part")).applyInArrow(_search(most, m2, same_label), FOUND)


def _top(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("vec_id")))
    return found.withColumn("rank", place).where(F.col("rank") <= most)


def _floors(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The score of the ``most``-th find, where there are as many."""
    return _top(found, keys, most).where(F.col("rank") == most).select(*keys, F.col("score").alias("floor"))


def mine(
    rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    shard: int = SHARD, sample: int = SAMPLE, group: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for each anchor (rows where ``anchor`` holds, over
    vec_id and label) and each of its best ``positives`` other rows of the
    same label, the best ``negatives`` rows of another label whose score s
    has low * p <= 100 * s <= high * p, p the positive's score.

    ``rows`` has vec_id, label and vec, whole-numbered components; scores are
    inner products, which must fit 64 bits; higher ones come first, ties by
    smaller id. Rows with a null id, label, vector or a null or non-finite
    component take no part, nor do further rows of an id; vectors of another
    length are never compared; other columns are left out. Anchors without
    positives, and windows without candidates, give no row.
    """
    points = stage(candidates(rows), "candidates")
    biggest, n, n_anchors = points.agg(
        F.max(F.aggregate("vec", F.lit(0.0), lambda s, v: s + v * v)), F.count(F.lit(1)), F.count_if(F.coalesce(anchor, F.lit(False)))
    ).first()
    m2, groups = float(biggest or 0.0), max(1, -(-n_anchors // group))
    pivots = choose_pivots(points, n, m2, shard, sample)
    celled = stage(points.mapInArrow(_cells(pivots, m2), "vec_id long, label long, vec array<double>, dim int, cell int"), "celled")
    trees = plant(celled, m2, shard)
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, v: s + v * v))
    anchors = celled.where(F.coalesce(anchor, F.lit(False))).select(F.col("vec_id").alias("anchor_id"), "label", "vec", "dim", "cell", norm.alias("norm"))
    top = F.lit(1 << 62)

    def both(asked: DataFrame, floored, keys: list[str], most: int, same_label: bool) -> DataFrame:
        asked = stage(asked, "asked")
        near = stage(_visit(trees, asked, True, groups, most, m2, same_label), "near")
        raised = stage(floored(asked, _floors(near, keys, most)), "raised")
        far = _visit(trees, raised, False, groups, most, m2, same_label)
        return stage(_top(near.unionByName(far), keys, most), "found")

    def one_floor(asked: DataFrame, floors: DataFrame) -> DataFrame:
        lo = F.coalesce("floor", -top)
        window = F.array(F.struct(F.lit(None).cast("long").alias("positive_id"), F.lit(None).cast("long").alias("positive_score"), lo.alias("lo"), top.alias("hi")))
        return asked.join(floors, "anchor_id", "left").withColumn("windows", window.cast(WINDOWS)).drop("floor")

    empty = points.sparkSession.createDataFrame([], "anchor_id long, floor long")
    found = both(one_floor(anchors, empty), lambda a, f: one_floor(a.drop("windows"), f), ["anchor_id"], positives, True)

    # 100 * s is whole: the window's ends are the whole scores inside it
    lo, hi = F.ceil(F.col("score") * F.lit(low).cast("decimal(20,0)") / 100), F.floor(F.col("score") * F.lit(high).cast("decimal(20,0)") / 100)
    window = F.struct(F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))
    windows = found.select("anchor_id", window.alias("w")).where("w.lo <= w.hi")
    windows = windows.groupBy("anchor_id").agg(F.array_sort(F.collect_list("w")).cast(WINDOWS).alias("windows"))  # at most `positives`

    def per_window(asked: DataFrame, floors: DataFrame) -> DataFrame:
        known = floors.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("positive_id", "floor"))).alias("known"))
        raised = F.transform(
            "windows",
            lambda w: F.struct(
                w["positive_id"].alias("positive_id"), w["positive_score"].alias("positive_score"),
                F.greatest(w["lo"], F.coalesce(F.try_element_at("known", w["positive_id"]), w["lo"])).alias("lo"), w["hi"].alias("hi"),
            ),
        )
        return asked.join(known, "anchor_id", "left").withColumn("windows", raised.cast(WINDOWS)).drop("known")

    keys = ["anchor_id", "positive_id", "positive_score"]
    out = both(anchors.join(windows, "anchor_id"), lambda a, f: per_window(a, f.drop("positive_score")), keys, negatives, False)
    return out.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
