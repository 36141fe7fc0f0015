"""Operators against a row-by-row brute force of the source's rules, on
random small logs (many groups per example, so one Spark job checks many)."""

import datetime as dt

from conftest import D
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from crewload import params as P
from crewload.operators.expand import pad_days
from crewload.plans import reconcile as rc
from crewload.schema import TXN

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

CODES = list(P.FA_RESERVE_CODES + (P.ASSIGNMENT_CODE,) + P.RELEASE_CODES + P.OVERLAP_CODES[:3])

group_rows = st.lists(
    st.tuples(st.sampled_from(CODES), st.one_of(st.none(), st.integers(0, 5))),
    min_size=1,
    max_size=7,
)


def brute_flags(rows):
    """The source: sort by stamp (NULL last; ties keep log order), number the
    rows, compare each row with the last position of a code set."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][1] is None, rows[i][1] or 0, i))
    codes = [rows[i][0] for i in order]

    def last(cs):
        hits = [n + 1 for n, x in enumerate(codes) if x in cs]
        return max(hits) if hits else None

    last_rsv = last(P.FA_RESERVE_CODES)
    last_claim = last(P.FA_RESERVE_CODES + (P.ASSIGNMENT_CODE,))
    last_asn = last((P.ASSIGNMENT_CODE,)) or 0
    released = last_rsv is not None and any(n + 1 > last_rsv and x in P.RELEASE_CODES for n, x in enumerate(codes))
    overlap = last_rsv is not None and any(n + 1 > last_claim and x in P.OVERLAP_CODES for n, x in enumerate(codes))
    released_asn = any(n + 1 > last_asn and x in P.ASSIGNMENT_RELEASE_CODES for n, x in enumerate(codes))
    return released, overlap, released_asn


@SETTINGS
@given(st.lists(group_rows, min_size=1, max_size=25))
def test_day_flags_match_row_number_rules(spark, groups):
    recs, want, seq = [], {}, 0
    for g, rows in enumerate(groups):
        day = D(1 + g % 28, 1)
        crew = f"c{g}"
        for code, stamp in rows:
            seq += 1
            ud = None if stamp is None else dt.date(2024, 1, 1)
            ut = None if stamp is None else f"08:00:0{stamp}"
            rec = dict(
                TXN_SEQ=seq, CREW_INDICATOR="FA", CREW_ID=crew, TRANSACTION_CODE=code, PAIRING_NO="1",
                PAIRING_DATE=day, TO_DATE=day, PAIRING_POSITION="FA", BID_PERIOD="2024-01", BASE="HNL",
                UPDATE_DATE=ud, UPDATE_TIME=ut,
            )
            recs.append(tuple(rec[f.name] for f in TXN.fields))
        want[crew] = brute_flags(rows)
    df = spark.createDataFrame(recs, TXN)
    params = P.RunParams(run_date=dt.date(2024, 1, 20))
    got = {
        r["CREW_ID"]: (r["released_reserve"], r["overlap"], r["released_asn"])
        for r in rc.day_flags(rc.explore_rows(df, params)).collect()
    }
    assert got == want


ends_strategy = st.lists(
    st.tuples(st.integers(0, 2), st.integers(1, 15), st.sampled_from(["PAIRING_DATE", "TO_DATE"]), st.one_of(st.none(), st.sampled_from("xyz"))),
    min_size=1,
    max_size=30,
)


def brute_pad(rows):
    out = []
    for g in sorted({r[0] for r in rows}):
        mine = sorted([r for r in rows if r[0] == g], key=lambda r: (r[1], r[2], r[4]))
        seen = None
        for i, (_, day, name, v, q) in enumerate(mine):
            seen = v if v is not None else seen
            out.append((g, day, name, seen))
            nxt = mine[i + 1][1] if i + 1 < len(mine) else None
            if nxt is not None and nxt > day:
                out.extend((g, d, None, seen) for d in range(day + 1, nxt))
    return sorted(out, key=repr)


@SETTINGS
@given(ends_strategy)
def test_pad_days_matches_brute_force(spark, raw):
    rows = [(g, day, name, v, q) for q, (g, day, name, v) in enumerate(raw)]
    df = spark.createDataFrame(
        [(str(g), D(day), name, v, q) for g, day, name, v, q in rows], "g string, DATE date, name string, v string, q long"
    )
    from pyspark.sql import functions as F

    got = pad_days(df, ["g"], ["v"], [F.col("name").asc_nulls_last(), F.col("q")]).collect()
    got = sorted(((int(r["g"]), r["DATE"].day, r["name"], r["v"]) for r in got), key=repr)
    assert got == brute_pad(rows)
