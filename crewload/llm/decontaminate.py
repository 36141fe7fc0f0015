"""Benchmark decontamination by template canonicalisation, on DataFrame and
SQL functions alone.

A text becomes a sequence of template tokens: words in lower case, numbers,
names (capitalised inside a sentence) and units as typed placeholders. Hashes
of all windows of ``WINDOW`` template tokens are joined with those of the
benchmark, so a question asked again with other numbers or names still meets
its template. For a document and item that share windows the slots of the two
are then compared place by place: a re-parameterised question maps each slot
value of the item to one value in the document.

An item that its template windows can't carry (a few words, a title in capitals,
an unspaced script) is looked for as it stands: windows of its plain tokens,
found in one alignment, whole for an item shorter than a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.joins import broadcast_if_small
from ..session import stage

WINDOW = 8  # a power of two: window hashes are built by doubling
MIN_LITERAL = 4  # literal words a window needs to be evidence
COVERAGE = 0.5  # share of an item's template tokens found in the document
CONSISTENT = 0.8  # share of slot places that follow one mapping of values
DRIFT = 4  # tokens between neighbouring diagonals of one alignment
MIN_EXACT = 3  # plain tokens of the shortest item that is looked for
BROADCAST_BYTES = 32 << 20  # measured; beyond it, a shuffle join

# --- fixed values: unit words that are no common words -------------------------
UNITS = (
    "km", "kg", "cm", "mm", "mg", "ml", "mph", "kmh", "kph", "lb", "lbs", "oz",
    "kilometers", "kilometer", "kilometres", "meters", "meter", "metres", "centimeters",
    "miles", "mile", "inches", "feet", "yards", "grams", "gram", "kilograms", "liters",
    "litres", "gallons", "dollars", "dollar", "euros", "euro", "cents", "percent",
    "seconds", "minutes", "hours", "hour", "days", "weeks", "months", "years", "degrees",
)
# --------------------------------------------------------------------------------

#: A number, or a word with the sentence end that follows it.
TOKEN = r"[0-9]+(?:[.,:/][0-9]+)*|\p{L}+(?:[.!?]+|\n)?"


#: Scripts without spaces between words: there a character is a token.
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
PLAIN = (
    rf"transform(regexp_extract_all(coalesce(text, ''), r'[0-9]+(?:[.,:/][0-9]+)*|[{UNSPACED}]|[\p{{L}}&&[^{UNSPACED}]]+', 0), x -> lower(x))"
)
RAW = f"regexp_extract_all(coalesce(text, ''), r'{TOKEN}', 0)"


def _let(value: str, name: str, body: str) -> str:
    """SQL: ``body`` with ``name`` bound to ``value``, evaluated once (a plain
    column would be inlined again at every use)."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _template(tokens: str) -> str:
    """SQL: the template tokens of an array variable; placeholders start with <."""
    units = ", ".join(f"'{u}'" for u in UNITS)
    return f"""transform({tokens}, (x, i) -> CASE
        WHEN x < ':' AND x >= '0' THEN '<num>'
        WHEN lower(x) IN ({units}) THEN '<unit>'
        WHEN i > 0 AND substring(x, 1, 1) <> lower(substring(x, 1, 1)) AND length(x) > 1
             AND substring(x, 2) = lower(substring(x, 2))
             AND NOT right({tokens}[i - 1], 1) IN ('.', '!', '?', '\\n') THEN '<name>'
        ELSE rtrim('.!?\\n', lower(x)) END)"""


def _hashes(template: str, window: int) -> str:
    """SQL: the hashes of all windows of an array variable, in order; pairs
    of neighbours are hashed, then pairs of pairs, up to the window."""
    width, steps = 1, []
    while width < window:
        a = f"h{width}"
        steps.append((f"h{2 * width}", f"zip_with({a}, slice({a}, {width + 1}, greatest(size({a}) - {width}, 0)), (x, y) -> xxhash64(x, y))"))
        width *= 2
    body = f"slice(h{window}, 1, greatest(size({template}) - {window - 1}, 0))"
    for name, value in reversed(steps):
        body = _let(value, name, body)
    return _let(f"transform({template}, x -> xxhash64(x))", "h1", body)


def _benchmark_windows(items: DataFrame, window: int, min_literal: int) -> DataFrame:
    """(h, item_id, at, first): every place of the informative windows;
    ``first`` marks the first place of a hash in its item."""
    literal = items.withColumn(
        "plain", F.expr("transform(template, x -> CASE WHEN left(x, 1) = '<' THEN 0 ELSE 1 END)")
    )
    win = literal.select("item_id", "plain", F.posexplode(F.expr(_let("template", "t", _hashes("t", window)))).alias("at", "h"))
    plain = F.expr(f"aggregate(slice(plain, at + 1, {window}), 0, (a, x) -> a + x)")
    first = F.col("at") == F.min("at").over(Window.partitionBy("h", "item_id"))
    return win.where(plain >= min_literal).select("h", "item_id", "at", first.alias("first"))


def _slots(hits: DataFrame, texts: DataFrame, items: DataFrame, by: list[str], window: int) -> DataFrame:
    """(by, n_slots, n_changed, consistency) of the slot places of the hits."""
    place = hits.join(texts, "doc_id").join(items, "item_id").select(
        *by, "pos", "at",
        F.expr(f"slice(template, at + 1, {window})").alias("kinds"),
        F.expr(f"slice(raw, at + 1, {window})").alias("old"),
        F.expr(f"slice(doc_raw, pos + 1, {window})").alias("new"),
    )
    place = place.select(*by, "pos", "at", F.posexplode(F.arrays_zip("kinds", "old", "new")).alias("k", "z"))
    place = place.where("left(z.kinds, 1) = '<'").select(
        *by, (F.col("at") + F.col("k")).alias("token"), (F.col("pos") + F.col("k")).alias("place"),
        F.expr("lower(rtrim('.!?\\n', z.old))").alias("old"), F.expr("lower(rtrim('.!?\\n', z.new))").alias("new"),
    ).distinct()
    mapping = place.groupBy(*by, "old", "new").agg(F.count(F.lit(1)).alias("n"))
    forward = mapping.groupBy(*by, "old").agg(
        F.sum("n").alias("n"), F.sum(F.expr("CASE WHEN old <> new THEN n ELSE 0 END")).alias("changed"),
        F.max(F.struct("n", "new")).alias("best"),
    )
    target = forward.groupBy(*by, F.col("best.new").alias("new")).agg(
        F.sum("n").alias("n"), F.sum("changed").alias("changed"), F.max("best.n").alias("kept")
    )
    return target.groupBy(*by).agg(
        F.sum("n").alias("n_slots"), F.sum("changed").alias("n_changed"), (F.sum("kept") / F.sum("n")).alias("consistency")
    )


def _alignments(hits: DataFrame) -> DataFrame:
    """The hits by occurrence, as (doc_id, item_id, merged, line, pos, at): once
    by their diagonal ``pos - at``, once by runs of diagonals at most ``DRIFT``
    apart (a copy with words put in or left out)."""
    line = hits.withColumn("line", F.col("pos") - F.col("at"))
    pair = Window.partitionBy("doc_id", "item_id").orderBy("line")
    lines = line.select("doc_id", "item_id", "line").distinct()
    lines = lines.withColumn("new", (F.col("line") - F.lag("line", 1).over(pair) > DRIFT).cast("int"))
    lines = lines.withColumn("run", F.coalesce(F.sum("new").over(pair), F.lit(0)))
    one = line.select("doc_id", "item_id", F.lit(False).alias("merged"), F.col("line").cast("long").alias("line"), "pos", "at")
    run = line.join(lines, ["doc_id", "item_id", "line"])
    return one.unionByName(run.select("doc_id", "item_id", F.lit(True).alias("merged"), F.col("run").cast("long").alias("line"), "pos", "at"))


def _verbatim(flat: DataFrame, items: DataFrame, keys: DataFrame, window: int, coverage: float) -> DataFrame:
    """(doc_id, item_id, n_windows, coverage) of items found word for word,
    among those whose informative windows (but the first, whose capital may
    read as a name) cover less than ``coverage``: a verbatim copy of any other
    item has all its windows.

    Windows of plain tokens are as wide as the item allows, a power of two up
    to ``window``. Those of one diagonal must cover ``coverage`` of the item's
    tokens, or all of an item of fewer than ``window`` tokens.
    """
    tokens = F.explode(F.expr(f"sequence(at, at + {window - 1})")).alias("token")
    reach = keys.where("at > 0").select("item_id", tokens).distinct().groupBy("item_id").agg(F.count(F.lit(1)).alias("reach"))
    weak = items.join(reach, "item_id", "left").where(F.coalesce(F.col("reach"), F.lit(0)) < coverage * F.size("raw"))
    weak = weak.select("item_id", F.expr(PLAIN).alias("plain")).withColumn("n", F.size("plain")).where(F.col("n") >= MIN_EXACT)
    width = F.least(F.lit(window), F.expr("1 << cast(floor(log2(n)) AS int)")).cast("int")
    weak = stage(weak.withColumn("width", width), "weak-items")
    hits = None
    for k in sorted(r["width"] for r in weak.select("width").distinct().collect()):  # at most log2(window) widths
        hashes = _let("plain", "p", _hashes("p", k))
        wanted = weak.where(F.col("width") == k).select("item_id", "n", F.posexplode(F.expr(hashes)).alias("at", "h"))
        wanted = broadcast_if_small(stage(wanted, "plain-windows"), BROADCAST_BYTES)
        found = flat.select("doc_id", F.posexplode(F.expr(_let(PLAIN, "p", _hashes("p", k)))).alias("pos", "h")).join(wanted, "h")
        found = found.select("doc_id", "item_id", "n", "at", (F.col("pos") - F.col("at")).alias("line"), F.lit(k).alias("width")).distinct()
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        return flat.sparkSession.createDataFrame([], StructType([flat.schema["doc_id"], items.schema["item_id"]])).selectExpr(
            "*", "cast(0 AS bigint) AS n_windows", "cast(0 AS double) AS coverage"
        )
    by = ["doc_id", "item_id", "n", "line"]
    lines = hits.groupBy(*by).agg(F.count(F.lit(1)).alias("n_windows"))
    covered = hits.select(*by, F.explode(F.expr("sequence(at, at + width - 1)")).alias("token")).distinct()
    lines = lines.join(covered.groupBy(*by).agg((F.count(F.lit(1)) / F.first("n")).alias("coverage")), by)
    lines = lines.where(F.col("coverage") >= F.when(F.col("n") < window, 1.0).otherwise(coverage))
    best = lines.groupBy("doc_id", "item_id").agg(F.max(F.struct("coverage", "n_windows")).alias("b"))
    return best.select("doc_id", "item_id", "b.n_windows", "b.coverage")


def contaminated_pairs(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    min_literal: int = MIN_LITERAL,
    coverage: float = COVERAGE,
    consistent: float = CONSISTENT,
) -> DataFrame:
    """One row per document and benchmark item that share a template window:
    (doc_id, item_id, n_windows, coverage, n_slots, n_changed, consistency,
    contaminated).

    ``n_windows`` counts the item's distinct windows found, ``coverage`` is
    the share of the item's template tokens they cover, ``n_slots`` and
    ``n_changed`` count slot places compared and those whose value differs,
    ``consistency`` is the share of them that follow the commonest mapping of
    their item value, which must also be the only source of its target (1.0
    without slots). These figures pool the pair, each window at its first
    place in the item. ``contaminated`` needs both shares, of the pool or of
    any single occurrence: its windows, at all their places in the item, are
    taken by diagonal, alone and with neighbouring diagonals.

    An item whose windows can't carry it is found word for word (see
    ``_verbatim``): then ``n_windows`` and ``coverage`` are of plain tokens,
    without slots. Items of fewer than ``MIN_EXACT`` tokens say too little and
    are not looked for.

    Null and empty texts share nothing. Rows of one id with other texts are
    compared each; a pair's row is then that of its most contaminated texts.
    Rows with a null id are left out; other columns are ignored; an empty
    table on either side gives no rows.
    """
    def keyed(rows: DataFrame, key: str) -> DataFrame:  # a text of an id
        rows = rows.select(F.col(key).cast("long").alias("id"), F.col("text").cast("string")).where("id is not null")
        return rows.select(F.struct("id", F.xxhash64("text").alias("h")).alias(key), "text")

    items = keyed(benchmark, "item_id").groupBy("item_id").agg(F.min("text").alias("text")).withColumn("raw", F.expr(RAW))
    items = stage(items.select("item_id", "text", "raw", F.expr(_let("raw", "r", _template("r"))).alias("template")), "items")
    windows = stage(_benchmark_windows(items, window, min_literal), "windows")
    keys = broadcast_if_small(windows, BROADCAST_BYTES)

    flat = keyed(docs, "doc_id")
    verbatim = stage(_verbatim(flat, items, windows, window, coverage), "verbatim")
    items = items.drop("text")
    hashes = _let(RAW, "r", _let(_template("r"), "t", _hashes("t", window)))
    found = flat.select("doc_id", F.posexplode(F.expr(hashes)).alias("pos", "h")).join(keys, "h")
    hits = stage(found.select("doc_id", "item_id", "pos", "at", "first").distinct(), "hits")
    pooled = hits.where("first")

    # tokens of the item that the windows found cover
    tokens = F.explode(F.expr(f"sequence(at, at + {window - 1})")).alias("token")
    covered = hits.select("doc_id", "item_id", "first", tokens).groupBy("doc_id", "item_id", "token").agg(F.max("first").alias("first"))
    covered = covered.groupBy("doc_id", "item_id").agg(F.count_if("first").alias("n_covered"), F.count(F.lit(1)).alias("n_any"))
    counts = pooled.groupBy("doc_id", "item_id").agg(F.countDistinct("at").alias("n_windows"))
    lengths = items.select("item_id", F.size("raw").alias("n_tokens"))
    pairs = counts.join(covered, ["doc_id", "item_id"]).join(lengths, "item_id")
    pairs = pairs.withColumn("coverage", F.col("n_covered") / F.col("n_tokens"))

    # slot places of the aligned windows, of the whole pair
    ids = broadcast_if_small(stage(hits.select("doc_id").distinct(), "ids"), BROADCAST_BYTES)
    texts = flat.join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    texts = stage(texts, "texts").select("doc_id", F.expr(RAW).alias("doc_raw"))
    slots = _slots(pooled, texts, items, ["doc_id", "item_id"], window)
    out = pairs.join(slots, ["doc_id", "item_id"], "left").withColumn("consistency", F.coalesce("consistency", F.lit(1.0)))
    passed = (F.col("coverage") >= coverage) & (F.col("consistency") >= consistent)
    out = stage(out.withColumn("pooled", passed), "pairs")

    # by occurrence, where the pool fails and an occurrence can cover enough
    open_ = out.where(~F.col("pooled") & (F.col("n_any") / F.col("n_tokens") >= coverage)).select("doc_id", "item_id")
    by = ["doc_id", "item_id", "merged", "line"]
    every = stage(_alignments(hits.join(open_, ["doc_id", "item_id"], "left_semi")), "alignments")
    share = every.select(*by, tokens).distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("n")).join(lengths, "item_id")
    share = share.where(F.col("n") / F.col("n_tokens") >= coverage).select(*by)
    every = every.join(share, by, "left_semi")
    spoilt = _slots(every, texts, items, by, window).where(F.col("consistency") < consistent).select(*by)
    found = share.join(spoilt, by, "left_anti").select("doc_id", "item_id").distinct().withColumn("found", F.lit(True))
    out = out.join(found, ["doc_id", "item_id"], "left").select(
        "doc_id", "item_id", "n_windows", "coverage",
        F.coalesce("n_slots", F.lit(0)).alias("n_slots"), F.coalesce("n_changed", F.lit(0)).alias("n_changed"), "consistency",
        (F.col("pooled") | F.coalesce("found", F.lit(False))).alias("contaminated"),
    )
    plain = verbatim.selectExpr("*", "0L AS n_slots", "0L AS n_changed", "1.0D AS consistency", "true AS contaminated")
    figures = ["n_windows", "coverage", "n_slots", "n_changed", "consistency"]
    both = out.unionByName(plain).select(F.col("doc_id.id").alias("doc_id"), F.col("item_id.id").alias("item_id"), F.struct("contaminated", *figures).alias("r"))
    best = both.groupBy("doc_id", "item_id").agg(F.max("r").alias("r"))
    return best.select("doc_id", "item_id", *(F.col(f"r.{c}") for c in figures), "r.contaminated")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    bad = contaminated_pairs(docs, benchmark, **options).where("contaminated").select("doc_id").distinct()
    bad = broadcast_if_small(stage(bad, "contaminated"), BROADCAST_BYTES)
    return docs.join(bad, docs["doc_id"].cast("long") == bad["doc_id"], "left_anti")
