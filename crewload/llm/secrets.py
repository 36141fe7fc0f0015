"""Secret scan: Aho-Corasick keyword prefilter, anchored regular expressions
only where a keyword stands, then embedded checksum validation.

A text is scanned as bytes (A-Z lower-cased for the automaton, so one pass
serves every keyword in either case). Only at a hit is the kind's expression
matched, anchored at that place. Kinds whose tokens embed a checksum or a
decodable header count only if that holds. Spans are in code points.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from bisect import bisect_left

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Block, blocks, word_spans

# --- fixed values: kinds in their listed order, keywords, expressions --------
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm", "jwt", "pem")
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "jwt": ("eyj",),
    "pem": ("-----begin ",),
}
PATTERNS = {
    "assign": re.compile(r"""(?ia)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "github": re.compile(r"gh[pousr]_([0-9A-Za-z]{36})(?![0-9A-Za-z])"),
    "npm": re.compile(r"npm_([0-9A-Za-z]{36})(?![0-9A-Za-z])"),
    "jwt": re.compile(r"(eyJ[A-Za-z0-9_-]++)\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++"),
    "pem": re.compile(  # header lines, then the base64 body; possessive, so a text is read once
        r"-----BEGIN [A-Z ]*PRIVATE KEY-----\s*+((?:Proc-Type:\s*+4\s*+,\s*+ENCRYPTED\s++|DEK-Info:\s*+[A-Za-z0-9-]++\s*+,\s*+[0-9A-Fa-f]++\s++"
        r"|[A-Za-z][A-Za-z0-9-]*+:(?:(?!-----)[^\r\n])*+\r?\n\s*+)*+)([A-Za-z0-9+/=\s]++)-----END [A-Z ]*PRIVATE KEY-----"
    ),
}
ENCRYPTED = re.compile(r"DEK-Info:\s*[A-Za-z0-9-]+\s*,\s*([0-9A-Fa-f]+)")  # the start vector is one cipher block
OPENSSH = b"openssh-key-v1\0"
#: After a miss, what all later hits inside would miss by, too: a run that no
#: full stop ends, or a run after it that none ends.
RUNS = {"jwt": re.compile(r"[A-Za-z0-9_-]++(?!\.)|[A-Za-z0-9_-]++\.(?=[A-Za-z0-9_-]++(?!\.[A-Za-z0-9_-]))")}
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 6, 20, 24
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
PLACEHOLDER = "[SECRET]"
# ------------------------------------------------------------------------------

HEX = np.zeros(256, bool)
HEX[[*range(0x30, 0x3A), *range(0x61, 0x67)]] = True


def _base62_crc(body: str) -> str:
    """The CRC-32 of a token body as six base-62 digits."""
    value, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = BASE62[digit] + out
    return out


def _token_checksum(m: re.Match) -> bool:
    return _base62_crc(m[1][:-6]) == m[1][-6:]


def _jwt_header(m: re.Match) -> bool:
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(m[1] + "=" * (-len(m[1]) % 4)))
    except (ValueError, TypeError, RecursionError):
        return False


def _der_length(der: bytes) -> bool:
    """The key's outer DER sequence must be as long as its length bytes say."""
    if len(der) < 3 or der[0] != 0x30:
        return False
    n = der[1] & 0x7F
    return len(der) == (2 + der[1] if der[1] < 0x80 else 2 + n + int.from_bytes(der[2 : 2 + n], "big"))


def _openssh_lengths(raw: bytes) -> bool:
    """The magic, cipher, kdf and kdf options, the number of keys, that many
    public keys and the private part must fill the body."""

    def after(at: int) -> int:  # behind a string field and its length
        return at + 4 + int.from_bytes(raw[at : at + 4], "big") if at + 4 <= len(raw) else len(raw) + 1

    at = after(after(after(len(OPENSSH))))
    keys, at = int.from_bytes(raw[at : at + 4], "big"), at + 4
    while keys > 0 and at < len(raw):
        keys, at = keys - 1, after(at)
    return keys == 0 and after(at) == len(raw)


def _key_body(m: re.Match) -> bool:
    try:
        raw = base64.b64decode("".join(m[2].split()), validate=True)
    except (binascii.Error, ValueError):
        return False
    if raw.startswith(OPENSSH):
        return _openssh_lengths(raw)
    if start := ENCRYPTED.search(m[1]):  # whole cipher blocks instead of DER
        block = len(start[1]) // 2
        return block in (8, 16) and len(raw) > 0 and len(raw) % block == 0
    return _der_length(raw)


VALID = {
    "assign": lambda m: len(m[2]) >= ASSIGN_MIN,
    "access": lambda m: len(m[0]) >= ACCESS_MIN,
    "github": _token_checksum,
    "npm": _token_checksum,
    "jwt": _jwt_header,
    "pem": _key_body,
}


def _automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def _near_hits(automaton, raw: bytes) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in bytes, leftmost and non-overlapping for
    each kind: a match that fails validation is passed over whole."""
    hits = [(end - n + 1, kind) for end, (kind, n) in automaton.iter(raw.lower().decode("latin-1"))]
    if not hits:
        return []
    text, free, found = raw.decode("latin-1"), dict.fromkeys(KINDS, 0), []
    for at, kind in sorted(hits):
        if at < free[kind]:
            continue
        if m := PATTERNS[kind].match(text, at):
            free[kind] = m.end()
            if VALID[kind](m):
                found.append((at, KINDS.index(kind), m.end()))
        elif kind in RUNS and (m := RUNS[kind].match(text, at)):
            free[kind] = m.end()
    return found


def _spans(automaton, block: Block) -> list[list[tuple[int, int, int]]]:
    start, end, doc = word_spans(block.data, block.offs, HEX)
    long = end - start >= HEX_MIN
    start, end, doc = start[long], end[long], doc[long].tolist()
    out = []
    for i in range(len(block)):
        raw = block.text(i)
        found = _near_hits(automaton, raw)
        lo = bisect_left(doc, i)
        while lo < len(doc) and doc[lo] == i:
            found.append((int(start[lo] - block.offs[i]), KINDS.index("hex"), int(end[lo] - block.offs[i])))
            lo += 1
        if found and not raw.isascii():  # bytes to code points
            before = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
            found = [(int(before[s]), k, int(before[e])) for s, k, e in found]
        out.append(sorted(found))
    return out


def _find(batches):
    automaton = _automaton()
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    for block in blocks(batches, "text"):
        spans = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in x] for x in _spans(automaton, block)]
        yield pa.RecordBatch.from_arrays(
            [block.batch.column(0), pa.array(spans, pa.list_(kind))], ["doc_id", "spans"]
        )


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) for every row: spans are (kind, start, end) in code
    points, end exclusive, by start and then kind as listed in ``KINDS``.

    A null or empty text has no spans; repeated rows give repeated result
    rows; a null doc_id stays null; other columns are ignored; an empty table
    gives no rows. Texts are scanned whole, whatever their length.
    """
    flat = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return flat.mapInArrow(_find, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def _redacted(column: str):
    def run(batches):
        automaton = _automaton()
        for block in blocks(batches, column):
            texts = block.batch.column(block.batch.schema.get_field_index(column)).to_pylist()
            for i, found in enumerate(_spans(automaton, block)):
                if found:
                    out, at, text = [], 0, texts[i]
                    for s, _, e in found:  # overlapping spans leave one placeholder
                        if s >= at:
                            out += [text[at:s], PLACEHOLDER]
                        at = max(at, e)
                    texts[i] = "".join([*out, text[at:]])
            at = block.batch.schema.get_field_index(column)
            yield block.batch.set_column(at, block.batch.schema.field(at), pa.array(texts, block.batch.schema.field(at).type))

    return run


def redact_secrets(docs: DataFrame, column: str = "text") -> DataFrame:
    """``docs`` with every secret in ``column`` replaced by ``PLACEHOLDER``;
    all rows, all other columns and texts without a secret stay as they are."""
    return docs.mapInArrow(_redacted(column), docs.schema)
