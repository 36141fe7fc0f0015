"""Chat formatting of reply trees.

Iterative self-joins enumerate the root-to-leaf paths: ancestor pointers are
doubled (the 1st, 2nd, 4th, ... ancestor of every node), so a tree of depth d
takes log2(d) rounds. The paths of a tree are ranked by their mean score and
each chosen path becomes one conversation.

Template: ``### role: text</turn>`` and a line end per turn. In texts and
roles a backslash stands before every backslash, ``#`` and ``<`` (in roles
also before ``:``), so no text holds a control string and removing one
backslash before any character gives the text back.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

TURN = re.compile(r"### ([^\\:]*(?:\\.[^\\:]*)*): ([^\\<]*(?:\\.[^\\<]*)*)</turn>\n", re.S)
UNESCAPE = re.compile(r"\\(.)", re.S)
ASSISTANT = "assistant"


def _pointers(nodes: DataFrame) -> list[DataFrame]:
    """(tree, node, up): the 2^k-th ancestor of every node that has one."""
    out = [stage(nodes.where("parent is not null").select("tree", "node", F.col("parent").alias("up")), "up")]
    most, span = nodes.count(), 1
    while span < most and not out[-1].isEmpty():  # a cycle ends at the number of nodes
        last = out[-1]
        far = last.select("tree", F.col("node").alias("up"), F.col("up").alias("far"))
        out.append(stage(last.join(far, ["tree", "up"]).select("tree", "node", F.col("far").alias("up")), "up"))
        span *= 2
    return out


def reply_paths(nodes: DataFrame, best: int = 1) -> DataFrame:
    """(tree, leaf, rank, node, depth) of the ``best`` paths of every tree.

    ``nodes`` has (tree, node, parent, score): parent null for a root. A path
    goes from a root to a node without replies and ranks by its mean score
    (null counts as 0), ties by the smaller leaf. A reply to a missing parent
    starts a path of its own; a reply that leads into a cycle is on no path;
    nodes with a null tree or node are left out; repeated (tree, node) rows
    count once.
    """
    nodes = nodes.where("tree is not null and node is not null").dropDuplicates(["tree", "node"])
    known = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    nodes = nodes.join(known, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("known"), F.col("parent")).alias("parent"), F.coalesce("score", F.lit(0.0)).alias("score")
    )
    nodes = stage(nodes, "nodes")
    ups = _pointers(nodes)
    inner = nodes.where("parent is not null").select("tree", F.col("parent").alias("node")).distinct()
    leaves = nodes.select("tree", "node").join(inner, ["tree", "node"], "left_anti")
    if not ups[-1].isEmpty():
        leaves = leaves.join(ups[-1].select("tree", "node"), ["tree", "node"], "left_anti")
    path = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).alias("height"))
    for k, up in enumerate(ups):
        higher = path.join(up, ["tree", "node"]).select("tree", "leaf", F.col("up").alias("node"), (F.col("height") + 2**k).alias("height"))
        path = stage(path.unionByName(higher), "path")
    scored = path.join(nodes.select("tree", "node", "score"), ["tree", "node"])
    branch = scored.groupBy("tree", "leaf").agg(F.avg("score").alias("mean"), F.max("height").alias("top"))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("mean"), "leaf"))
    chosen = branch.withColumn("rank", rank).where(F.col("rank") <= best)
    return path.join(chosen, ["tree", "leaf"]).select("tree", "leaf", "rank", "node", (F.col("top") - F.col("height")).alias("depth"))


def _escaped(text: str, more: str = "") -> str:
    """SQL: ``text`` with a backslash before each control character."""
    return f"regexp_replace({text}, r'([\\\\#<{more}])', r'\\\\$1')"


def format_paths(nodes: DataFrame, best: int = 1) -> DataFrame:
    """(tree, leaf, rank, formatted, loss_spans): one conversation per chosen
    path. ``nodes`` also has role and text (null: empty). ``loss_spans`` are
    the code point ranges of the assistant's (escaped) texts in ``formatted``.
    """
    turns = nodes.select("tree", "node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = turns.dropDuplicates(["tree", "node"])
    path = reply_paths(nodes, best).join(turns, ["tree", "node"])
    piece = path.select(
        "tree", "leaf", "rank", "depth", (F.col("role") == ASSISTANT).alias("loss"),
        F.expr(f"concat('### ', {_escaped('role', ':')}, ': ')").alias("head"), F.expr(_escaped("text")).alias("body"),
    )
    whole = piece.groupBy("tree", "leaf", "rank").agg(
        F.array_sort(F.collect_list(F.struct("depth", "loss", "head", "body"))).alias("turns")  # one path
    )
    end = r"concat('</turn>', char(10))"
    spans = f"""aggregate(turns, named_struct('at', 0L, 'spans', cast(array() AS array<struct<start:bigint,end:bigint>>)),
        (a, t) -> named_struct(
            'at', a.at + length(t.head) + length(t.body) + length({end}),
            'spans', CASE WHEN t.loss THEN concat(a.spans, array(named_struct(
                'start', a.at + length(t.head), 'end', a.at + length(t.head) + length(t.body)))) ELSE a.spans END),
        a -> a.spans)"""
    return whole.select(
        "tree", "leaf", "rank",
        F.expr(f"array_join(transform(turns, t -> concat(t.head, t.body, {end})), '')").alias("formatted"),
        F.expr(spans).alias("loss_spans"),
    )


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((UNESCAPE.sub(r"\1", m[1]), UNESCAPE.sub(r"\1", m[2])))
        at = m.end()
    return out


def _digests(batches):
    for batch in batches:
        out = []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            turns = parse(text)
            loss = "".join(UNESCAPE.sub(r"\1", text[s["start"] : s["end"]]) for s in spans)
            whole = "".join(f"{role}\n{body}\n" for role, body in turns)
            sha = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, loss)]
            out.append((len(turns), sha[0], len(loss), sha[1], len(text)))
        cols = [list(c) for c in zip(*out, strict=True)] or [[]] * 5
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
            ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
        )


def read_back(formatted: DataFrame) -> DataFrame:
    """Counts and digests read from formatted conversations alone."""
    rows = formatted.select(F.col("tree").cast("long").alias("conv_id"), "formatted", "loss_spans")
    return rows.mapInArrow(
        _digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def reply_chains(conversations: DataFrame) -> DataFrame:
    """Tree nodes of a table of rows by turn: each row answers the row before
    it (by turn, role and text; a repeated row is a turn of its own). Rows
    with a null conv_id belong to no conversation and are left out."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("tree"), F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).where("tree is not null")
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = rows.withColumn("node", F.row_number().over(order).cast("long"))
    return rows.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))
