"""DuckDB SQL of the operators that SQL can express, written from their
definitions: no hashes, no signatures, all candidate pairs.

The SQL takes each ``doc_id`` and ``item_id`` as unique and not null, as in
the given tables; the odd cases are in the tests.
"""

from __future__ import annotations

from .decontaminate import CONSISTENT, COVERAGE, MIN_LITERAL, TOKEN, UNITS, WINDOW
from .minhash import PERCENT
from .mixing import SEED, SYMBOLS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SAID = r"\### Assistant: </turn> ok"  # the turns of conversation -7

# Every text through the template: a control character costs one escape.
OP5 = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
    UNION ALL SELECT -7, 0, 'user', '{SAID}'
    UNION ALL SELECT -7, 1, 'assistant', '{SAID}'
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length('### : </turn>') + 1 + 2 * length(role) - length(translate(role, '\#<:', ''))
        + 2 * length(text) - length(translate(text, '\#<', ''))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

# Every pair of documents that share a shingle is compared.
OP10 = rf"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), word AS (
    SELECT doc_id, len(words) AS n, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM split
), five AS (
    SELECT doc_id, n, i, w, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2, lead(w, 3) OVER o AS w3, lead(w, 4) OVER o AS w4
    FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), shingle AS (
    SELECT DISTINCT doc_id, concat_ws(' ', w, w1, w2, w3, w4) AS s FROM five WHERE w4 IS NOT NULL OR (n < 5 AND i = 1)
), size AS (
    SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), pair AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS same
    FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2
), link AS (
    SELECT a, b FROM pair JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b
    WHERE 100 * same >= {PERCENT} * (p.n + q.n - same)
), edge AS (
    SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT reach.a, edge.b FROM reach JOIN edge ON edge.a = reach.b
), class AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(size.n, 0) AS n_shingles, class.component_id, d.doc_id = class.component_id AS kept
FROM documents d JOIN class USING (doc_id) LEFT JOIN size USING (doc_id)
"""

_UNITS = ", ".join(f"'{u}'" for u in UNITS)
_ENDS = "'.!?' || chr(10)"


def _tokens(name: str, table: str, key: str) -> str:
    """The template tokens of a table: (key, i from 0, raw, kind)."""
    return rf"""
{name}_raw AS (
    SELECT {key}, unnest(r) AS raw, generate_subscripts(r, 1) - 1 AS i
    FROM (SELECT {key}, regexp_extract_all(coalesce(text, ''), '{TOKEN}') AS r FROM {table})
), {name}_seen AS (
    SELECT {key}, i, raw, lag(raw) OVER (PARTITION BY {key} ORDER BY i) AS prev FROM {name}_raw
), {name} AS (
    SELECT {key}, i, raw, CASE
        WHEN raw >= '0' AND raw < ':' THEN '<num>'
        WHEN lower(raw) IN ({_UNITS}) THEN '<unit>'
        WHEN prev IS NOT NULL AND length(raw) > 1 AND left(raw, 1) <> lower(left(raw, 1))
            AND raw[2:] = lower(raw[2:]) AND NOT contains({_ENDS}, right(prev, 1)) THEN '<name>'
        ELSE rtrim(lower(raw), {_ENDS}) END AS kind
    FROM {name}_seen
), {name}_window AS (
    SELECT {key}, i, string_agg(kind, ' ') OVER w AS h, count(*) OVER w AS n,
        count(*) FILTER (WHERE NOT starts_with(kind, '<')) OVER w AS plain
    FROM {name} WINDOW w AS (PARTITION BY {key} ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)
)"""


# Windows meet as text; slots are compared token by token.
OP3 = rf"""
WITH {_tokens("item", "benchmark", "item_id")}, {_tokens("doc", "documents", "doc_id")},
keyed AS (
    SELECT item_id, h, min(i) AS start FROM item_window WHERE n = {WINDOW} AND plain >= {MIN_LITERAL} GROUP BY item_id, h
), hit AS (
    SELECT doc_id, item_id, doc_window.i AS pos, start FROM doc_window JOIN keyed USING (h) WHERE n = {WINDOW}
), step AS (
    SELECT DISTINCT doc_id, item_id, start + k AS token, pos + k AS place FROM hit, range({WINDOW}) AS r(k)
), pair AS (
    SELECT doc_id, item_id, n_windows, n_covered / n_tokens AS coverage
    FROM (SELECT doc_id, item_id, count(DISTINCT start) AS n_windows FROM hit GROUP BY 1, 2)
    JOIN (SELECT doc_id, item_id, count(DISTINCT token) AS n_covered FROM step GROUP BY 1, 2) USING (doc_id, item_id)
    JOIN (SELECT item_id, count(*) AS n_tokens FROM item GROUP BY 1) USING (item_id)
), mapping AS (
    SELECT step.doc_id, step.item_id, lower(rtrim(item.raw, {_ENDS})) AS old, lower(rtrim(doc.raw, {_ENDS})) AS new, count(*) AS n
    FROM step JOIN item ON item.item_id = step.item_id AND item.i = token JOIN doc ON doc.doc_id = step.doc_id AND doc.i = place
    WHERE starts_with(item.kind, '<') GROUP BY ALL
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id, item_id, old ORDER BY n DESC, new DESC) AS nth FROM mapping
), forward AS (
    SELECT doc_id, item_id, old, sum(n) AS n, sum(CASE WHEN old <> new THEN n ELSE 0 END) AS changed,
        max(n) AS kept, max(CASE WHEN nth = 1 THEN new END) AS new
    FROM ranked GROUP BY doc_id, item_id, old
), target AS (
    SELECT doc_id, item_id, sum(n) AS n, sum(changed) AS changed, max(kept) AS kept FROM forward GROUP BY doc_id, item_id, new
), slot AS (
    SELECT doc_id, item_id, CAST(sum(n) AS BIGINT) AS n_slots, CAST(sum(changed) AS BIGINT) AS n_changed,
        CAST(sum(kept) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS consistency
    FROM target GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, n_windows, coverage, coalesce(n_slots, 0) AS n_slots, coalesce(n_changed, 0) AS n_changed,
    coalesce(consistency, 1.0::DOUBLE) AS consistency, coverage >= {COVERAGE} AND coalesce(consistency, 1.0) >= {CONSISTENT} AS contaminated
FROM pair LEFT JOIN slot USING (doc_id, item_id)
"""

# Every anchor against every row.
OP11 = """
WITH typed AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CASE WHEN isfinite(x::DOUBLE) THEN floor(256 * x::DOUBLE) END) AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
), r AS (
    SELECT * FROM typed WHERE len(list_filter(v, lambda x: x IS NULL)) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positive AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 3
"""

# The capped shares in closed form: sources by cap per weight, the first k
# capped; keys and prefix sums over all rows at once.
OP12 = rf"""
WITH d AS (
    SELECT doc_id, source, text, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), weighted AS (
    SELECT doc_id, source, size,
        1 / (1 + 4 * coalesce((length(text) - length(translate(text, '{SYMBOLS}', '')))::DOUBLE / nullif(size, 0), 0.0::DOUBLE)) AS weight,
        (('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
    FROM d
), keyed AS (
    SELECT *, -ln(u) / weight AS key FROM weighted
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source
), w AS (
    SELECT source, source_size, [5, 2, 1][1 + (place - 1) % 3] AS w, 3 * source_size AS cap, sum(source_size) OVER () AS total FROM s
), o AS (
    SELECT *, coalesce(sum(cap) OVER b, 0) AS capped, coalesce(sum(w) OVER a, 0) AS free,
        row_number() OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST) AS k
    FROM w WINDOW b AS (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
        a AS (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), first_free AS (
    SELECT k, (total - capped)::DOUBLE AS num, free::DOUBLE AS den FROM o WHERE w * (total - capped) <= cap * free ORDER BY k LIMIT 1
), t AS (
    SELECT source, source_size, CASE WHEN o.k < f.k THEN cap::DOUBLE ELSE w * num / den END AS target FROM o LEFT JOIN first_free f ON true
), b AS (
    SELECT source, source_size, target, floor(target + 0.5)::BIGINT AS budget,
        CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS whole FROM t
), placed AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS LAST, size, weight
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM keyed
)
SELECT doc_id, size, source_size, target, CAST(whole * size + greatest(0, least(budget - whole * source_size - before, size)) AS BIGINT) AS taken
FROM placed JOIN b ON placed.source IS NOT DISTINCT FROM b.source
"""

ORACLES = {
    "op3_template_decontamination": OP3,
    "op5_reply_trees": OP5,
    "op10_circulant_minhash": OP10,
    "op11_cover_tree": OP11,
    "op12_exponential_mix": OP12,
}
