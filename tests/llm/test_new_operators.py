"""Operators 11 to 13 against brute force, and their odd rows."""

import hashlib
import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from crewload.llm import hard_negatives, mixing, repair
from pyspark.sql import functions as F

# --- 11 hard negatives -------------------------------------------------------

VEC = "vec_id long, label int, vec array<double>, cell int, score string, dim string"


def brute_negatives(rows, every, positives=5, negatives=3, low=50, high=95):
    ok = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ok[i] = min(ok[i], (label, v)) if i in ok else (label, v)
    out = []
    for a, (la, va) in ok.items():
        if a % every:
            continue
        scored = [(-sum(int(x) * int(y) for x, y in zip(va, v)), i, label) for i, (label, v) in ok.items() if len(v) == len(va)]
        for s, p, _ in sorted(x for x in scored if x[2] == la and x[1] != a)[:positives]:
            inside = sorted(x for x in scored if x[2] != la and low * -s <= 100 * -x[0] <= high * -s)[:negatives]
            out.extend((a, p, n, i, -s, -t) for n, (t, i, _) in enumerate(inside, 1))
    return sorted(out)


def mined(spark, rows, every=10, **kw):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], VEC)
    return sorted(tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % every == 0, **kw).collect())


@pytest.mark.parametrize("kind", ["sphere", "clusters", "copies", "lattice"])
def test_negatives_match_brute_force(spark, kind):
    rng = np.random.default_rng(11)
    n = 400
    if kind == "sphere":
        x = rng.normal(size=(n, 6))
        x = np.floor(256 * x / np.linalg.norm(x, axis=1, keepdims=True))
    elif kind == "clusters":
        x = np.floor(200 * rng.normal(size=(8, 5))[rng.integers(0, 8, n)] + 9 * rng.normal(size=(n, 5)))
    elif kind == "copies":  # a third of all rows is one vector
        x = np.floor(60 * rng.normal(size=(n, 4)))
        x[: n // 3] = x[0]
    else:  # many ties and zero vectors
        x = rng.integers(-2, 3, size=(n, 3)).astype(float)
    rows = [(i, int(rng.integers(0, 3)), v.tolist()) for i, v in enumerate(x)]
    got = mined(spark, rows, shard=60, sample=100, group=9)
    assert got == brute_negatives(rows, 10) and got


def test_negatives_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [3.0, 4.0]), (1, 1, [3.0, 4.0]), (2, 2, [3.0, 1.0]), (2, 2, [3.0, 1.0]), (3, 2, [2.0, 2.0]), (4, 2, None),
        (5, None, [3.0, 1.0]), (6, 2, [nan, 1.0]), (7, 2, [inf, 1.0]), (8, 2, [None, 1.0]), (None, 2, [3.0, 1.0]),
        (9, 2, [1.0]), (10, 1, [1.0]), (11, 1, [2.0]), (20, 5, []), (21, 5, []), (22, 6, []), (30, 7, [0.0, 0.0]), (31, 7, [5.0, 5.0]),
    ]
    assert mined(spark, rows) == brute_negatives(rows, 10)
    assert mined(spark, []) == []
    assert mined(spark, [(0, 1, [1.0]), (1, 2, [1.0])]) == []  # an anchor without positives
    big = float(1 << 30)
    far = [(0, 1, [big, 1.0]), (1, 1, [big, 3.0]), (2, 2, [big / 2 + 1, 5.0]), (3, 2, [big * 0.95, -7.0]), (4, 2, [big, 0.0])]
    assert mined(spark, far) == brute_negatives(far, 10)  # products past the doubles' whole numbers


def test_cover_tree_radii_halve_and_cover():
    rng = np.random.default_rng(4)
    x = np.floor(np.concatenate([40 * rng.normal(size=(300, 4)), 300 + 5 * rng.normal(size=(300, 4)), np.ones((50, 4))]))
    m2 = float((x * x).sum(axis=1).max())
    tree = hard_negatives.build_tree(np.arange(len(x)), np.zeros(len(x), int), x, m2)
    assert sorted(tree["ids"]) == list(range(len(x)))
    aug, mid = hard_negatives.augmented(tree["x"], m2), hard_negatives.augmented(tree["centre"], m2)

    def below(node):
        lo, hi = tree["own"][node], tree["own"][node + 1]
        return list(range(lo, hi)) + [i for c in range(*tree["child"][node]) for i in below(c)]

    chord = 2 * np.sqrt(m2) * np.sin(tree["angle"] / 2)
    for node in range(len(tree["angle"])):
        inside = below(node)
        assert np.linalg.norm(aug[inside] - mid[node], axis=1).max() <= chord[node] * (1 + 1e-9) + 1e-6
        kids = range(*tree["child"][node])
        assert all(chord[c] <= chord[node] / 2 + 1e-6 for c in kids)
        for a, b in itertools.combinations(kids, 2):
            assert np.linalg.norm(mid[a] - mid[b]) > chord[node] / 2 - 1e-6


def test_descent_skips_nodes_outside_the_window(monkeypatch):
    rng = np.random.default_rng(9)
    means = 300 * rng.normal(size=(12, 8))
    x = np.floor(np.repeat(means, 200, axis=0) + rng.normal(size=(2400, 8)))
    m2 = float((x * x).sum(axis=1).max())
    tree = hard_negatives.build_tree(np.arange(len(x)), np.repeat(np.arange(12), 200), x, m2)
    seen = []
    scores = hard_negatives._scores
    monkeypatch.setattr(hard_negatives, "_scores", lambda x, q, e: seen.append(len(x)) or scores(x, q, e))
    q = x[0]
    best = hard_negatives.Best(5, -1e18, 1e18)
    hard_negatives.descend(tree, q, [best], lambda ls, ids: ls == 0, tree["centre"] @ q, True)
    assert sum(seen) < len(x) / 4
    want = sorted((-int(s), i) for i, s in enumerate(x @ q) if i < 200)[:5]
    assert best.found == want


# --- 12 mixing ----------------------------------------------------------------

DOC = "doc_id long, source string, size long, weight double, key string, before int, w int, cap int, row string"


def mixed(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "k", 1, 2, 3, "r") for r in rows], DOC)
    return mixing.mix(df, F.col("size"), F.col("weight"), **kw).collect()


def fair_shares(sizes, weights, epochs):
    """Reshare by hand until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(epochs * sizes[s] for s in capped)
        rest = sum(w[s] for s in names if s not in capped)
        t = {s: epochs * sizes[s] if s in capped else left * w[s] / rest for s in names} if rest else {s: epochs * sizes[s] for s in names}
        over = {s for s in names if s not in capped and t[s] > epochs * sizes[s]}
        if not over:
            return t
        capped |= over


def test_mix_meets_targets_in_key_order(spark):
    rng = np.random.default_rng(2)
    names = [f"s{i}" for i in range(7)] + [None, "", "é"]
    share = rng.dirichlet(np.full(len(names), 0.4))
    rows = [(i, names[rng.choice(len(names), p=share)], int(rng.integers(0, 300)), float(rng.random())) for i in range(3000)]
    rows += [(9000, "s1", 4_000, 0.5)] * 400  # copies of one row, over a third of all words
    got = mixed(spark, rows)
    sizes = Counter()
    for _, s, n, _ in rows:
        sizes[s] += n
    want = fair_shares(sizes, mixing.SOURCE_WEIGHTS, mixing.EPOCHS)
    taken, by_source = Counter(), {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        by_source.setdefault(r.source, []).append(r)
    assert len(got) == len(rows) and all(abs(taken[s] - want[s]) <= 0.5 + 1e-6 for s in sizes)
    for s, found in by_source.items():  # complete epochs first, then a prefix in key order
        def key(r):
            u = (int(hashlib.md5(f"{mixing.SEED}:{r.doc_id}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            return -math.log(u) / max(r.weight, mixing.LEAST_WEIGHT)
        whole = int(want[s] + 0.5) // sizes[s] if sizes[s] else 0
        more = [(r.taken - whole * r.size, r.size) for r in sorted((r for r in found if r.size), key=lambda r: (key(r), -r.taken))]
        assert all(0 <= m <= n for m, n in more)
        full = [m == n for m, n in more]
        cut = full.index(False) if False in full else len(full)
        assert all(m == 0 for m, _ in more[cut + 1 :])
    again = mixed(spark, rows[::-1])
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_better_documents_are_drawn_earlier(spark):
    rows = [(i, "a", 10, 1.0 if i % 2 else 0.05) for i in range(2000)] + [(i, "b", 10, 1.0) for i in range(2000, 8000)]
    got = [r for r in mixed(spark, rows, weights=(1, 7)) if r.source == "a"]
    assert got[0].target == 10_000
    good, bad = (sum(r.taken for r in got if r.doc_id % 2 == k) for k in (1, 0))
    assert good > 4 * bad


def test_mix_odd_rows(spark):
    assert mixed(spark, []) == []
    zero = mixed(spark, [(1, "a", 0, 1.0), (2, None, 0, None)])
    assert [(r.target, r.taken) for r in zero] == [(0.0, 0), (0.0, 0)]
    odd = mixed(spark, [(None, "a", 5, float("nan")), (None, "a", 5, None), (1, "a", 5, -1.0), (1, "a", 5, float("inf")), (2, "a", 5, 0.0)])
    assert sum(r.taken for r in odd) == 25 and all(r.taken == 5 for r in odd)
    one = mixed(spark, [(1, "a", 1, 1.0), (2, "b", 99, 1.0), (3, "c", 0, 1.0)])
    assert {r.doc_id: (r.target, r.taken) for r in one} == {1: (3.0, 3), 2: (97.0, 97), 3: (0.0, 0)}


def test_sizes_and_weights_of_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " a\tb\x0bc d \n"), (4, "## ##"), (5, "x " * 100_000)], "doc_id long, text string")
    size = mixing.word_count()
    got = {r.doc_id: (r.n, r.w) for r in df.select("doc_id", size.alias("n"), mixing.text_quality(size).alias("w")).collect()}
    assert got == {1: (0, 1.0), 2: (0, 1.0), 3: (3, 1.0), 4: (2, 1 / 9), 5: (100_000, 1.0)}


# --- 13 conversation repair ------------------------------------------------------

ROW = "conv_id long, turn long, role string, text string, audit string, copy int, nth int, kind string"


def faults(turns):
    seen, out = set(), []
    for role, text in turns:
        core = text.rstrip(" \t\n\v\f\r")
        out.append("blank" if not core else "duplicate" if (role, text) in seen else "" if core[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def legal(roles):
    s = "".join(r[:1] if len(r) else "?" for r in roles)
    s = s[1:] if s.startswith("su") else s
    return s == "ua" * (len(s) // 2) and (bool(s) or not roles)


def exhaustive(turns):
    """Every edit sequence with at most three insertions."""
    found = faults(turns)
    best = None
    for inserts in range(4):
        for places in itertools.combinations_with_replacement(range(len(turns) + 1), inserts):
            for names in itertools.product(("user", "assistant"), repeat=inserts):
                for edits in itertools.product("KDua", repeat=len(turns)):
                    cost, audit, out = 5 * inserts, "", []
                    for i in range(len(turns) + 1):
                        for p, name in zip(places, names):
                            if p == i:
                                audit += "I"
                                out.append((name, ""))
                        if i == len(turns):
                            break
                        e, (role, text) = edits[i], turns[i]
                        if e == "D":
                            cost, audit = cost + 2, audit + "D"
                            continue
                        if found[i] in ("blank", "duplicate"):
                            break
                        cost += 5 * (found[i] == "truncated") + (e != "K")
                        audit += "K" if e == "K" else "R"
                        out.append(({"u": "user", "a": "assistant"}.get(e, role), text))
                    else:
                        i = len(turns)
                    if i < len(turns) or not legal([r for r, _ in out]):
                        continue
                    here = (cost, audit, "\n".join(f"{r}:{t}" for r, t in out))
                    best = here if best is None or here[:2] < best[:2] else best
    return best


def plain_dp(turns):
    """The same DP over whole strings and texts."""
    step = {("E", "s"): "S", ("E", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}
    want = {"E": ("user", "U"), "S": ("user", "U"), "U": ("assistant", "A"), "A": ("user", "U")}

    def inserted(best):
        for _ in range(4):
            for s, (c, a, out) in list(best.items()):
                name, to = want[s]
                new = (c + 5, a + "I", (*out, f"{name}:"))
                best[to] = min(best.get(to, new), new, key=lambda x: x[:2])
        return best

    best = inserted({"E": (0, "", ())})
    for (role, text), fault in zip(turns, faults(turns)):
        new = {}
        for s, (c, a, out) in best.items():
            moves = [(s, (c + 2, a + "D", out))]
            if fault not in ("blank", "duplicate"):
                c5 = c + 5 * (fault == "truncated")
                if (s, role[:1]) in step:
                    moves.append((step[s, role[:1]], (c5, a + "K", (*out, f"{role}:{text}"))))
                name, to = want[s]
                moves.append((to, (c5 + 1, a + "R", (*out, f"{name}:{text}"))))
            for to, x in moves:
                new[to] = min(new.get(to, x), x, key=lambda x: x[:2])
        best = inserted(new)
    c, a, out = min((best[s] for s in "EA" if s in best), key=lambda x: x[:2])
    return c, a, "\n".join(out)


def conversations(n, longest, seed):
    rng = np.random.default_rng(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "Uma"]
    texts = ["a.", "b!", "c", "", " \n", "d?", "e. \t", "f "]
    return [
        [(roles[rng.integers(0, 8 if i % 3 else 3)], texts[rng.integers(0, 8)]) for _ in range(rng.integers(0, longest + 1))] for i in range(n)
    ]


def repaired(spark, groups, run=repair.repair):
    rows = [(c, i, r, t, "x", 0, 5, "z") for c, turns in enumerate(groups) for i, (r, t) in enumerate(turns)]
    return run(spark.createDataFrame(rows, ROW)).collect()


def test_plain_dp_is_the_exhaustive_minimum():
    for turns in conversations(40, 3, 1):
        assert plain_dp(turns) == exhaustive(turns), turns


def test_audits_match_the_plain_dp(spark):
    groups = conversations(300, 14, 2) + conversations(3, 700, 3)
    for r in repaired(spark, groups):
        turns = groups[r.conv_id]
        cost, audit, text = plain_dp(turns)
        assert (r.cost, r.audit, r.repaired_sha256) == (cost, audit, hashlib.sha256(text.encode()).hexdigest()), turns[:20]
        count = Counter(faults(turns))
        assert (r.blank, r.duplicate, r.truncated, r.gaps) == (count["blank"], count["duplicate"], count["truncated"], 0)
        pairs = [a[0][:1] + b[0][:1] for a, b in itertools.pairwise(turns)]
        assert r.illegal == sum(p not in ("su", "ua", "au") for p in pairs)


def test_repaired_turns_read_in_order(spark):
    groups = conversations(60, 200, 5)
    found = {}
    for r in sorted(repaired(spark, groups, repair.repaired_turns), key=lambda r: (r.conv_id, r.place)):
        found.setdefault(r.conv_id, []).append((r.role, r.text))
    for c, turns in enumerate(groups):
        out = found.get(c, [])
        assert legal([r for r, _ in out]) and "\n".join(f"{r}:{t}" for r, t in out) == plain_dp(turns)[2]


def test_hash_collisions_are_verified(spark, monkeypatch):
    monkeypatch.setattr(repair, "_MOD", 3)  # nearly all hashes collide
    for turns in conversations(60, 12, 7):
        audit = repair.Audit()
        for (role, text), fault in zip(turns, faults(turns)):
            audit.add(role, text, fault)
        cost, rest = audit.finish()
        assert (cost, "".join(e for e, _, _ in rest)) == plain_dp(turns)[:2]


def test_a_long_conversation_keeps_a_short_tail():
    audit = repair.Audit()
    edits = 0
    for i in range(20_000):
        audit.add("user" if i % 2 == 0 else "assistant", f"{i}.", "" if i % 7 else "truncated")
        if i % repair.FLUSH_ROWS == 0:
            edits += sum(1 for _ in audit.decided())
            assert len(audit.pending) < 200 and max(n.depth for _, n in audit.best.values()) < 200
    assert edits > 19_000


def test_damage_and_odd_rows(spark):
    items = [(c, t) for c in (1, 2, None, 30) for t in (0, 1, 2, None, 9)]
    rows = [(c, t, "user" if (t or 0) % 2 == 0 else None, "Hi. There! ok?" if t else None, "x", 1, 1, "k") for c, t in items] * 2
    df = spark.createDataFrame(rows, ROW)
    hurt = repair.damage(df)
    want = Counter()
    for c, t, role, text, *_ in rows:
        role, text = role or " ", text or " "
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if kind == 1 else text.translate({ord(x): None for x in ".!?"}) if kind == 2 else text
        want[(c, t, "user" if kind == 4 else role, text, kind != 0)] += 1 + (kind == 3)
    assert Counter((r.conv_id, r.turn, r.role, r.text, r.present) for r in hurt.collect()) == want
    got = {r.conv_id: r for r in repair.repair(hurt).collect()}
    assert set(got) == {1, 2, None, 30}
    none = repair.repair(df.withColumn("present", F.lit(False))).collect()
    assert {(r.gaps, r.blank, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in none} == {(0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    gaps = spark.createDataFrame([(1, 5, "user", "a."), (1, 9, "user", "b."), (1, None, "user", "c."), (2, None, "user", "a.")], "conv_id long, turn long, role string, text string")
    assert {r.conv_id: r.gaps for r in repair.repair(gaps).collect()} == {1: 3, 2: 0}
    assert repair.repair(df.limit(0)).collect() == [] and repair.repaired_turns(df.limit(0)).collect() == []
    long = [(1, i, "user" if i % 2 == 0 else "assistant", "w " * 50_000 + f"{i}.") for i in range(6)]
    one = repair.repair(spark.createDataFrame(long, "conv_id long, turn long, role string, text string")).collect()
    assert one[0].audit == "KKKKKK" and one[0].repaired_sha256 == hashlib.sha256("\n".join(f"{r}:{t}" for _, _, r, t in long).encode()).hexdigest()
