"""DuckDB oracle: one ANSI-SQL text per registered query.

Written independently of the Spark plans, in the source's own terms: group
flags use row numbers in stamp order (not the aggregate shortcut the Spark
side takes), padding joins a generated day series back to the trip ends,
the downward fill is ``last_value(... IGNORE NULLS)``. Only the base views
(``events``, ``orders`` ...) are registered, so the crew views are inlined
as CTEs.
"""

from __future__ import annotations

import datetime as dt

from crewload import params as P

# --- fixed values: the two derived crew views (FIXTURES.md §2) -------------
TXN_SQL = """SELECT TXN_SEQ, CREW_INDICATOR, CREW_ID, TRANSACTION_CODE,
  CASE WHEN TRANSACTION_CODE='ASN' THEN CAST(TXN_SEQ % 200 AS STRING) END AS PAIRING_NO,
  PAIRING_DATE,
  CASE WHEN TXN_SEQ % 97 = 0 THEN NULL WHEN TRANSACTION_CODE='ASN' THEN PAIRING_DATE + CAST(TXN_SEQ % 4 AS INT) ELSE PAIRING_DATE END AS TO_DATE,
  PAIRING_POSITION, substr(CAST(PAIRING_DATE AS STRING),1,7) AS BID_PERIOD, BASE,
  PAIRING_DATE - CAST(TXN_SEQ % 60 AS INT) AS UPDATE_DATE, UPDATE_TIME
FROM (SELECT event_id AS TXN_SEQ,
  CASE WHEN user_id % 3 = 0 THEN 'P' ELSE 'FA' END AS CREW_INDICATOR,
  CAST(user_id AS STRING) AS CREW_ID,
  CASE WHEN event_type IN ('signup','view') THEN
         CASE WHEN user_id % 3 = 0 THEN CASE WHEN event_id % 2 = 0 THEN 'SCR' ELSE 'ARC' END
              ELSE CASE WHEN event_id % 2 = 0 THEN 'RLV' ELSE 'RSV' END END
       WHEN event_type = 'purchase' THEN 'ASN'
       WHEN event_type = 'error' THEN CASE event_id % 4 WHEN 0 THEN 'SNO' WHEN 1 THEN 'GDO' WHEN 2 THEN 'OFF' ELSE 'DRP' END
       ELSE CASE event_id % 9 WHEN 0 THEN 'FLP' WHEN 1 THEN 'FLU' WHEN 2 THEN '2SK' WHEN 3 THEN 'FLV' WHEN 4 THEN 'FLS' WHEN 5 THEN 'SOP' WHEN 6 THEN 'REM' WHEN 7 THEN 'FAR' ELSE 'MIL' END END AS TRANSACTION_CODE,
  CAST(ts AS DATE) + CAST(30 * (user_id % 4) AS INT) AS PAIRING_DATE,
  CASE WHEN user_id % 3 <> 0 THEN 'FA' WHEN user_id % 15 = 0 THEN 'SO' WHEN user_id % 6 = 0 THEN 'CA' ELSE 'FO' END AS PAIRING_POSITION,
  CASE WHEN event_id % 89 = 0 THEN NULL WHEN user_id % 5 = 0 THEN 'LAX' WHEN user_id % 5 = 1 THEN 'SEA' ELSE 'HNL' END AS BASE,
  substr(CAST(ts AS STRING),12,8) AS UPDATE_TIME
  FROM events) e"""

SCHED_SQL = """SELECT o_orderkey AS SCHED_SEQ, CAST(o_custkey AS STRING) AS CREW_ID,
  DATE '2024-01-01' + CAST(30 * (o_orderkey % 4) AS INT) AS EFFECTIVE_FROM_DATE,
  DATE '2024-01-30' + CAST(30 * (o_orderkey % 4) AS INT) AS EFFECTIVE_TO_DATE,
  CASE substr(o_orderpriority,1,1) WHEN '1' THEN '717' WHEN '2' THEN '789' WHEN '3' THEN '33Y' WHEN '4' THEN '330' ELSE NULL END AS EQUIPMENT,
  CASE WHEN o_custkey % 3 <> 0 THEN 'FA' WHEN o_custkey % 15 = 0 THEN 'SO' WHEN o_custkey % 6 = 0 THEN 'CA' ELSE 'FO' END AS PAIRING_POSITION,
  concat('2024-0', CAST(1 + o_orderkey % 4 AS STRING)) AS BID_DATE,
  CAST(o_orderdate AS DATE) AS UPDATE_DATE, '12:00:00' AS UPDATE_TIME,
  CASE WHEN o_custkey % 5 = 0 THEN 'LAX' WHEN o_custkey % 5 = 1 THEN 'SEA' ELSE 'HNL' END AS BASE,
  o_orderstatus AS BID_TYPE
FROM orders"""
# ---------------------------------------------------------------------------

SILVER = "CREW_INDICATOR, CREW_ID, TRANSACTION_CODE, PAIRING_DATE, PAIRING_POSITION, BID_PERIOD, BASE, EQUIPMENT"
FIRST = "update_dt NULLS LAST, TXN_SEQ"
FILL = ("CREW_INDICATOR", "CREW_ID", "TRANSACTION_CODE", "PAIRING_POSITION", "BID_PERIOD", "BASE")
STAMP = "CAST(UPDATE_DATE AS VARCHAR) || ' ' || UPDATE_TIME"


def d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def inlist(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def nsj(a: str, b: str, cols) -> str:
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols)


def first_row(keys, order: str = FIRST) -> str:
    return f"QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) = 1"


class Sql:
    """Accumulates named CTEs in dependency order."""

    def __init__(self):
        self.ctes: dict[str, str] = {}

    def add(self, name: str, body: str) -> str:
        if name not in self.ctes:
            self.ctes[name] = body
        return name

    def render(self, final: str) -> str:
        withs = ",\n".join(f"{n} AS (\n{b}\n)" for n, b in self.ctes.items())
        return f"WITH {withs}\n{final}"


# --- sources ---------------------------------------------------------------


def txn(s: Sql) -> str:
    return s.add("txn", TXN_SQL)


def sched(s: Sql) -> str:
    return s.add("sched", SCHED_SQL)


def window(s: Sql, name: str, lo: dt.date, hi: dt.date) -> str:
    t = txn(s)
    return s.add(name, f"SELECT * FROM {t} WHERE PAIRING_DATE BETWEEN {d(lo)} AND {d(hi)}")


def bid_scan(s: Sql, p: P.RunParams) -> str:
    t = txn(s)
    return s.add("bid_scan", f"SELECT * FROM {t} WHERE BID_PERIOD BETWEEN {q(p.first_bid_period)} AND {q(p.last_bid_period)}")


# --- shared pieces -----------------------------------------------------------


def fill_all(src: str, cols, group, order: str, within=(), fill=FILL) -> str:
    """Ungrouped downward fill of all rows: groups by key, days ascending."""
    keys = ", ".join(f"{g} NULLS LAST" for g in group)
    part = f"PARTITION BY {', '.join(within)} " if within else ""
    w = f"{part}ORDER BY {keys}, DATE, name NULLS LAST, {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    return ", ".join(f"last_value({c} IGNORE NULLS) OVER ({w}) AS {c}" if c in fill else c for c in cols) + f" FROM {src}"


def pad_fill(s: Sql, prefix: str, ends: str, group, carry, order: str, fill=FILL, literal: bool = False, within=()) -> str:
    """Insert missing days per group between first and last DATE of its ends,
    then fill ``fill`` downward inside the group. ``carry`` are the other end
    columns (NULL on inserted days). ``literal``: one fill over all groups."""
    gk = ", ".join(group)
    bounds = s.add(f"{prefix}_bounds", f"SELECT {gk}, min(DATE) AS lo, max(DATE) AS hi FROM {ends} GROUP BY {gk}")
    days = s.add(
        f"{prefix}_days",
        f"SELECT {gk}, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS DATE FROM {bounds}",
    )
    others = [c for c in carry if c not in group]
    padded = s.add(
        f"{prefix}_padded",
        f"SELECT {', '.join('g.' + c for c in group)}, g.DATE, {', '.join('e.' + c for c in others)}\n"
        f"FROM {days} g LEFT JOIN {ends} e ON {nsj('g', 'e', group)} AND g.DATE = e.DATE",
    )
    if literal:
        cols = [*group, "DATE", *others]
        return s.add(f"{prefix}_filled", "SELECT " + fill_all(padded, cols, group, order, within, fill))
    wdef = f"PARTITION BY {gk} ORDER BY DATE, name NULLS LAST, {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    cols = []
    for c in list(group) + ["DATE"] + others:
        if c in fill and c not in group:
            cols.append(f"last_value({c} IGNORE NULLS) OVER ({wdef}) AS {c}")
        else:
            cols.append(c)
    return s.add(f"{prefix}_filled", f"SELECT {', '.join(cols)} FROM {padded}")


def unpivot_ends(src: str, cols) -> str:
    c = ", ".join(cols)
    return (
        f"SELECT {c}, 'PAIRING_DATE' AS name, PAIRING_DATE AS DATE FROM {src} WHERE PAIRING_DATE <> TO_DATE\n"
        f"UNION ALL SELECT {c}, 'TO_DATE' AS name, TO_DATE AS DATE FROM {src} WHERE PAIRING_DATE <> TO_DATE"
    )


# --- flight attendants (M4, M5) ---------------------------------------------

ASN_CARRY = ("CREW_INDICATOR", "CREW_ID", "TRANSACTION_CODE", "PAIRING_NO", "PAIRING_POSITION", "BID_PERIOD", "BASE", "update_dt", "TXN_SEQ")


def fa_scan(s: Sql, p: P.RunParams, backfill: bool) -> str:
    if backfill:
        src = bid_scan(s, p)
    else:
        lo, hi = p.bounds(p.fa_window)
        src = window(s, "fa_win", lo, hi)
    return s.add(f"{src}_st", f"SELECT *, {STAMP} AS update_dt FROM {src}")


def fa_cutoff(p: P.RunParams, backfill: bool) -> str:
    if backfill:
        return (
            f"strftime(CAST(BID_PERIOD || '-{p.backfill_cutoff_day:02d}' AS DATE) - INTERVAL 1 MONTH, '%Y-%m-%d')"
            " || ' 00:00:00'"
        )
    month = (p.run_date + dt.timedelta(days=p.cutoff_lead_days)).replace(day=1) - dt.timedelta(days=1)
    return q(month.strftime("%Y-%m") + f"-{p.incremental_cutoff_day:02d} 00:00:00")


def fa_reserve(s: Sql, p: P.RunParams, backfill: bool) -> str:
    scan = fa_scan(s, p, backfill)
    tag = "bf" if backfill else "inc"
    return s.add(
        f"fa_rsv_{tag}",
        f"SELECT CREW_INDICATOR, CREW_ID, TRANSACTION_CODE, PAIRING_DATE, PAIRING_POSITION, BID_PERIOD, BASE, 'NA' AS EQUIPMENT, update_dt, TXN_SEQ\n"
        f"FROM {scan} WHERE CREW_INDICATOR = 'FA' AND TRANSACTION_CODE IN {inlist(P.FA_RESERVE_CODES)}"
        f" AND update_dt < {fa_cutoff(p, backfill)}\n"
        + first_row([*(["BID_PERIOD"] if backfill else []), "CREW_ID", "PAIRING_DATE", "TRANSACTION_CODE"]),
    )


def fa_asn(s: Sql, p: P.RunParams, backfill: bool) -> str:
    scan = fa_scan(s, p, backfill)
    tag = "bf" if backfill else "inc"
    cols = ", ".join(ASN_CARRY[:4]) + ", PAIRING_DATE, TO_DATE, " + ", ".join(ASN_CARRY[4:])
    if backfill or p.asn_rows_only:
        where = "CREW_INDICATOR = 'FA' AND TRANSACTION_CODE = 'ASN'"
    else:
        hit = s.add(
            "fa_asn_days",
            f"SELECT DISTINCT CREW_ID, PAIRING_DATE FROM {scan} WHERE CREW_INDICATOR = 'FA' AND TRANSACTION_CODE = 'ASN'",
        )
        where = (
            f"CREW_INDICATOR = 'FA' AND EXISTS (SELECT 1 FROM {hit} h WHERE h.CREW_ID IS NOT DISTINCT FROM x.CREW_ID"
            " AND h.PAIRING_DATE IS NOT DISTINCT FROM x.PAIRING_DATE)"
        )
    keys = [*(["BID_PERIOD"] if backfill else []), "CREW_ID", "PAIRING_DATE", "TRANSACTION_CODE"] + ([] if backfill else ["update_dt"])
    return s.add(f"fa_asn_{tag}", f"SELECT {cols} FROM {scan} x WHERE {where}\n" + first_row(keys))


def fa_day_keys(backfill: bool):
    return [*(["BID_PERIOD"] if backfill else []), "CREW_ID", "TRANSACTION_CODE", "DATE", "PAIRING_NO"]


def fa_single(s: Sql, p: P.RunParams, backfill: bool) -> str:
    asn = fa_asn(s, p, backfill)
    tag = "bf" if backfill else "inc"
    keys = [k if k != "DATE" else "PAIRING_DATE" for k in fa_day_keys(backfill)]
    return s.add(
        f"fa_single_{tag}",
        f"SELECT CREW_INDICATOR, CREW_ID, TRANSACTION_CODE, PAIRING_DATE, PAIRING_POSITION, BID_PERIOD, BASE, 'NA' AS EQUIPMENT\n"
        f"FROM {asn} WHERE PAIRING_DATE = TO_DATE\n" + first_row(keys),
    )


def fa_ends(s: Sql, p: P.RunParams, backfill: bool) -> str:
    asn = fa_asn(s, p, backfill)
    tag = "bf" if backfill else "inc"
    return s.add(
        f"fa_ends_{tag}",
        f"SELECT * FROM (\n{unpivot_ends(asn, ASN_CARRY)}\n) u\n" + first_row(fa_day_keys(backfill)),
    )


def fa_pad_keys(backfill: bool):
    return ["BID_PERIOD", "CREW_ID", "BASE", "PAIRING_NO"] if backfill else ["CREW_ID", "PAIRING_NO", "update_dt"]


def fa_multi_filled(s: Sql, p: P.RunParams, backfill: bool) -> str:
    ends = fa_ends(s, p, backfill)
    tag = "bf" if backfill else "inc"
    within = ["BID_PERIOD"] if backfill else []
    return pad_fill(
        s, f"fa_pad_{tag}", ends, fa_pad_keys(backfill), list(ASN_CARRY) + ["name"], FIRST, literal=p.literal_fill, within=within
    )


def fa_multi(s: Sql, p: P.RunParams, backfill: bool) -> str:
    filled = fa_multi_filled(s, p, backfill)
    tag = "bf" if backfill else "inc"
    return s.add(
        f"fa_multi_{tag}",
        f"SELECT CREW_INDICATOR, CREW_ID, TRANSACTION_CODE, DATE AS PAIRING_DATE, PAIRING_POSITION, BID_PERIOD, BASE, 'NA' AS EQUIPMENT FROM {filled}",
    )


def fa_silver(s: Sql, p: P.RunParams, backfill: bool) -> str:
    tag = "bf" if backfill else "inc"
    rsv, single, multi = fa_reserve(s, p, backfill), fa_single(s, p, backfill), fa_multi(s, p, backfill)
    cap = p.run_date if backfill else p.incremental_cap
    return s.add(
        f"fa_silver_{tag}",
        "SELECT CREW_INDICATOR, CREW_ID, CASE WHEN TRANSACTION_CODE = 'RSV' THEN 'RLV' ELSE TRANSACTION_CODE END AS TRANSACTION_CODE,"
        " PAIRING_DATE, PAIRING_POSITION, BID_PERIOD, BASE, 'NA' AS EQUIPMENT FROM (\n"
        f"SELECT {SILVER} FROM {rsv} UNION ALL SELECT {SILVER} FROM {single} UNION ALL SELECT {SILVER} FROM {multi}\n"
        f") u WHERE PAIRING_DATE <= {d(cap)}",
    )


# --- pilots (M12, M6, M7) ----------------------------------------------------


def sched_latest(s: Sql, p: P.RunParams, backfill: bool) -> str:
    sc = sched(s)
    if backfill:
        where, keys = f"BID_DATE BETWEEN {q(p.first_bid_period)} AND {q(p.last_bid_period)}", "BID_DATE, "
    else:
        lo, hi = p.pilot_bid_range
        where, keys = f"BID_DATE BETWEEN {q(lo)} AND {q(hi)}", ""
    tag = "bf" if backfill else "inc"
    ranked = s.add(
        f"sched_ranked_{tag}",
        f"SELECT *, max({STAMP}) OVER (PARTITION BY {keys}CREW_ID, EFFECTIVE_FROM_DATE, EFFECTIVE_TO_DATE, PAIRING_POSITION) AS top_dt,"
        f" {STAMP} AS update_dt FROM {sc} WHERE {where}",
    )
    return s.add(
        f"sched_latest_{tag}",
        f"SELECT CREW_ID, BID_DATE AS BID_PERIOD, PAIRING_POSITION, EQUIPMENT, BASE FROM {ranked}\n"
        "WHERE update_dt = top_dt OR top_dt IS NULL\n"
        + first_row([*(["BID_DATE"] if backfill else []), "CREW_ID", "EFFECTIVE_FROM_DATE", "EFFECTIVE_TO_DATE", "PAIRING_POSITION"],
                    "update_dt DESC NULLS LAST, SCHED_SEQ DESC"),
    )


def pilot_scan(s: Sql, p: P.RunParams, backfill: bool) -> str:
    if backfill:
        src = bid_scan(s, p)
    else:
        lo, hi = p.bounds(p.pilot_window)
        src = window(s, "pilot_win", lo, hi)
    return s.add(f"{src}_st", f"SELECT *, {STAMP} AS update_dt FROM {src}")


PJOIN = ("CREW_ID", "BID_PERIOD", "PAIRING_POSITION", "BASE")


def pilot_rows(s: Sql, p: P.RunParams, backfill: bool, kind: str) -> str:
    scan = pilot_scan(s, p, backfill)
    tag = "bf" if backfill else "inc"
    codes = P.PILOT_RESERVE_CODES if kind == "rsv" else (P.ASSIGNMENT_CODE,)
    keys = [*(["BID_PERIOD"] if backfill else []), "CREW_ID", "PAIRING_DATE", "TRANSACTION_CODE"]
    cut = ""
    if kind == "rsv" and not backfill and p.pilot_cutoff_day is not None:
        cut = f" AND update_dt < {fa_cutoff(p.with_(incremental_cutoff_day=p.pilot_cutoff_day), False)}"
    return s.add(
        f"pilot_{kind}_rows_{tag}",
        f"SELECT * FROM {scan} WHERE CREW_INDICATOR = 'P' AND TRANSACTION_CODE IN {inlist(codes)}{cut}\n" + first_row(keys),
    )


def pilot_reserve(s: Sql, p: P.RunParams, backfill: bool) -> str:
    rows, ms = pilot_rows(s, p, backfill, "rsv"), sched_latest(s, p, backfill)
    tag = "bf" if backfill else "inc"
    how = "LEFT JOIN" if backfill else "JOIN"
    return s.add(
        f"pilot_rsv_{tag}",
        "SELECT r.CREW_INDICATOR, r.CREW_ID, r.TRANSACTION_CODE, r.PAIRING_DATE, r.PAIRING_POSITION, r.BID_PERIOD, r.BASE, m.EQUIPMENT\n"
        f"FROM {rows} r {how} {ms} m ON {nsj('r', 'm', PJOIN)}\nWHERE r.PAIRING_POSITION IN {inlist(P.PILOT_SEATS)}",
    )


PASN_CARRY = ("CREW_INDICATOR", "CREW_ID", "TRANSACTION_CODE", "PAIRING_NO", "PAIRING_POSITION", "BID_PERIOD", "BASE", "EQUIPMENT", "update_dt", "TXN_SEQ")


def pilot_asn(s: Sql, p: P.RunParams, backfill: bool) -> str:
    rows, ms = pilot_rows(s, p, backfill, "asn"), sched_latest(s, p, backfill)
    tag = "bf" if backfill else "inc"
    return s.add(
        f"pilot_asn_{tag}",
        "SELECT r.CREW_INDICATOR, r.CREW_ID, r.TRANSACTION_CODE, r.PAIRING_NO, r.PAIRING_DATE, r.TO_DATE, r.PAIRING_POSITION,"
        " r.BID_PERIOD, r.BASE, m.EQUIPMENT, r.update_dt, r.TXN_SEQ\n"
        f"FROM {rows} r JOIN {ms} m ON {nsj('r', 'm', PJOIN)}\nWHERE r.PAIRING_POSITION IN {inlist(P.PILOT_SEATS)}",
    )


def pilot_day_keys(backfill: bool):
    return [*(["BID_PERIOD"] if backfill else []), "CREW_ID", "EQUIPMENT", "TRANSACTION_CODE", "DATE"]


def pilot_single(s: Sql, p: P.RunParams, backfill: bool) -> str:
    asn = pilot_asn(s, p, backfill)
    tag = "bf" if backfill else "inc"
    keys = [k if k != "DATE" else "PAIRING_DATE" for k in pilot_day_keys(backfill)]
    return s.add(
        f"pilot_single_{tag}",
        f"SELECT {SILVER} FROM {asn} WHERE PAIRING_DATE = TO_DATE\n" + first_row(keys),
    )


def pilot_multi_filled(s: Sql, p: P.RunParams, backfill: bool) -> str:
    asn = pilot_asn(s, p, backfill)
    tag = "bf" if backfill else "inc"
    ends = s.add(
        f"pilot_ends_{tag}",
        f"SELECT * FROM (\n{unpivot_ends(asn, PASN_CARRY)}\n) u\n" + first_row(pilot_day_keys(backfill)),
    )
    group = [*(["BID_PERIOD"] if backfill else []), "CREW_ID", "TRANSACTION_CODE", "EQUIPMENT", "PAIRING_NO"]
    within = ["BID_PERIOD"] if backfill else []
    return pad_fill(s, f"pilot_pad_{tag}", ends, group, list(PASN_CARRY) + ["name"], FIRST, literal=p.literal_fill, within=within)


def pilot_multi(s: Sql, p: P.RunParams, backfill: bool) -> str:
    filled = pilot_multi_filled(s, p, backfill)
    tag = "bf" if backfill else "inc"
    return s.add(
        f"pilot_multi_{tag}",
        "SELECT CREW_INDICATOR, CREW_ID, TRANSACTION_CODE, DATE AS PAIRING_DATE, PAIRING_POSITION, BID_PERIOD, BASE, EQUIPMENT"
        f" FROM {filled}",
    )


def pilot_silver(s: Sql, p: P.RunParams, backfill: bool) -> str:
    tag = "bf" if backfill else "inc"
    rsv, single, multi = pilot_reserve(s, p, backfill), pilot_single(s, p, backfill), pilot_multi(s, p, backfill)
    u = f"SELECT {SILVER} FROM {rsv} UNION ALL SELECT {SILVER} FROM {single} UNION ALL SELECT {SILVER} FROM {multi}"
    if backfill:
        frm = "ARC" if p.fold_arc_in_backfill else P.BACKFILL_TYPO_CODE
        body = (
            f"SELECT CREW_INDICATOR, CREW_ID, CASE WHEN TRANSACTION_CODE = {q(frm)} THEN 'SCR' ELSE TRANSACTION_CODE END AS TRANSACTION_CODE,"
            " PAIRING_DATE, PAIRING_POSITION, BID_PERIOD, BASE, EQUIPMENT\n"
            f"FROM ({u}) u WHERE PAIRING_DATE <= {d(p.run_date)} AND EQUIPMENT <> '33Y'"
            f" AND NOT (PAIRING_DATE < {d(p.flag_date)} AND EQUIPMENT = '789')"
        )
    else:
        body = (
            "SELECT CREW_INDICATOR, CREW_ID, CASE WHEN TRANSACTION_CODE = 'ARC' THEN 'SCR' ELSE TRANSACTION_CODE END AS TRANSACTION_CODE,"
            " PAIRING_DATE, PAIRING_POSITION, BID_PERIOD,"
            " CASE WHEN EQUIPMENT IS NULL THEN NULL WHEN EQUIPMENT = '717' THEN 'HNL' ELSE BASE END AS BASE, EQUIPMENT\n"
            f"FROM ({u}) u WHERE PAIRING_DATE <= {d(p.incremental_cap)} AND EQUIPMENT <> '33Y'"
        )
    return s.add(f"pilot_silver_{tag}", body)


# --- reconciliation (M9-M11, M1) --------------------------------------------

DAYK = ("CREW_ID", "PAIRING_DATE")
EX_PAD = ["CREW_ID", "PAIRING_NO", "update_dt"]
MATCH = ("CREW_INDICATOR", "CREW_ID", "PAIRING_DATE", "PAIRING_POSITION", "BID_PERIOD", "BASE", "EQUIPMENT")


def ex_flag(s: Sql, p: P.RunParams) -> str:
    """The source's way: row numbers in stamp order per (crew, day), the last
    position of each code set, and per-row "after" tests."""
    lo, hi = p.bounds(p.explore_window)
    src = window(s, "ex_win", lo, hi)
    rows = s.add(
        "ex_rows",
        f"SELECT *, {STAMP} AS update_dt FROM {src} WHERE CREW_INDICATOR = 'FA'"
        f" AND (CREW_ID IS NULL OR CREW_ID NOT IN {inlist(P.PLACEHOLDER_CREW_IDS)})",
    )
    pos = s.add(
        "ex_pos",
        f"SELECT *, row_number() OVER (PARTITION BY CREW_ID, PAIRING_DATE ORDER BY {FIRST}) AS rn FROM {rows}",
    )
    g = "OVER (PARTITION BY CREW_ID, PAIRING_DATE)"
    return s.add(
        "ex_flag",
        f"SELECT *, rn > last_rlv_pos AND TRANSACTION_CODE IN {inlist(P.RELEASE_CODES)} AS occurs_after_last_rlv,"
        f" rn > last_dropcode AND TRANSACTION_CODE IN {inlist(P.OVERLAP_CODES)} AS occurs_last_sno,"
        f" rn > last_asn_pos AND TRANSACTION_CODE IN {inlist(P.ASSIGNMENT_RELEASE_CODES)} AS occurs_after_last_asn FROM (\n"
        f"SELECT *, max(CASE WHEN TRANSACTION_CODE IN {inlist(P.FA_RESERVE_CODES)} THEN rn END) {g} AS last_rlv_pos,"
        f" max(CASE WHEN TRANSACTION_CODE IN {inlist(P.FA_RESERVE_CODES + (P.ASSIGNMENT_CODE,))} THEN rn END) {g} AS last_dropcode,"
        f" coalesce(max(CASE WHEN TRANSACTION_CODE = 'ASN' THEN rn END) {g}, 0) AS last_asn_pos FROM {pos}) x",
    )


def w3(s, p):
    f = ex_flag(s, p)
    return s.add(
        "w3",
        f"SELECT CREW_ID, PAIRING_DATE FROM {f} WHERE last_rlv_pos IS NOT NULL GROUP BY CREW_ID, PAIRING_DATE"
        " HAVING bool_or(occurs_after_last_rlv)",
    )


def w4(s, p):
    f = ex_flag(s, p)
    return s.add("w4", f"SELECT DISTINCT CREW_ID, PAIRING_DATE FROM {f} WHERE last_rlv_pos IS NOT NULL AND occurs_last_sno")


def w5(s, p):
    f = ex_flag(s, p)
    return s.add(
        "w5",
        f"SELECT CREW_ID, PAIRING_DATE FROM {f} GROUP BY CREW_ID, PAIRING_DATE HAVING bool_or(occurs_after_last_asn)",
    )


def not_in_days(alias: str, days: str, cols=DAYK) -> str:
    return f"NOT EXISTS (SELECT 1 FROM {days} z WHERE {nsj('z', alias, cols)})"


def m9(s, p):
    f, rej = ex_flag(s, p), w3(s, p)
    return s.add(
        "m9",
        "SELECT CREW_INDICATOR, CREW_ID, TRANSACTION_CODE, PAIRING_DATE, PAIRING_POSITION, BID_PERIOD, BASE, 'NA' AS EQUIPMENT, update_dt, TXN_SEQ\n"
        f"FROM {f} x WHERE last_rlv_pos IS NOT NULL AND TRANSACTION_CODE IN {inlist(P.FA_RESERVE_CODES)} AND {not_in_days('x', rej)}\n"
        + first_row(["CREW_ID", "PAIRING_DATE", "TRANSACTION_CODE"]),
    )


def w6(s, p):
    """The commented rule, step by step: a running count, a lag, any()."""
    f = ex_flag(s, p)
    w = f"OVER (PARTITION BY CREW_ID, PAIRING_DATE ORDER BY {FIRST}"
    rows = s.add(
        "w6_rows",
        f"SELECT CREW_ID, PAIRING_DATE, TRANSACTION_CODE = 'RLV' AS rlv, sum(CASE WHEN TRANSACTION_CODE = 'RLV' THEN 1 ELSE 0 END)"
        f" {w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) > 0 AS has_rlv,"
        f" lag(TRANSACTION_CODE IN ('SNO', 'GDO', 'OFF'), 1, false) {w}) AS after_release FROM {f}",
    )
    return s.add(
        "w6",
        f"SELECT CREW_ID, PAIRING_DATE, bool_or(has_rlv AND after_release) AS released FROM {rows}"
        " GROUP BY CREW_ID, PAIRING_DATE HAVING bool_or(rlv)",
    )


def m9_running(s, p):
    f, g = ex_flag(s, p), w6(s, p)
    return (
        f"SELECT {SILVER} FROM (SELECT *, 'NA' AS EQUIPMENT FROM {f}) x WHERE TRANSACTION_CODE IN {inlist(P.FA_RESERVE_CODES)}"
        f" AND EXISTS (SELECT 1 FROM {g} z WHERE NOT released AND {nsj('z', 'x', DAYK)})\n"
        + first_row(["CREW_ID", "PAIRING_DATE", "TRANSACTION_CODE"])
    )


def m10(s, p):
    f, rej = ex_flag(s, p), w5(s, p)
    return s.add(
        "m10",
        "SELECT CREW_INDICATOR, CREW_ID, TRANSACTION_CODE, PAIRING_NO, PAIRING_DATE, TO_DATE, PAIRING_POSITION, BID_PERIOD, BASE, update_dt, TXN_SEQ\n"
        f"FROM {f} x WHERE TRANSACTION_CODE = 'ASN' AND {not_in_days('x', rej)}\n"
        + first_row(["CREW_ID", "PAIRING_DATE", "TRANSACTION_CODE"]),
    )


def ex_single(s, p):
    a = m10(s, p)
    return s.add(
        "ex_single",
        f"SELECT {SILVER}, PAIRING_NO, update_dt FROM (SELECT *, 'NA' AS EQUIPMENT FROM {a} WHERE PAIRING_DATE = TO_DATE) x\n"
        + first_row(["CREW_ID", "TRANSACTION_CODE", "PAIRING_DATE", "PAIRING_NO"]),
    )


def ex_filled(s, p):
    a = m10(s, p)
    ends = s.add(
        "ex_ends",
        f"SELECT * FROM (\n{unpivot_ends(a, ASN_CARRY)}\n) u\n" + first_row(["CREW_ID", "TRANSACTION_CODE", "DATE", "PAIRING_NO"]),
    )
    return pad_fill(s, "ex_pad", ends, EX_PAD, list(ASN_CARRY) + ["name"], FIRST, literal=p.literal_fill)


def ex_multi(s, p):
    f = ex_filled(s, p)
    return s.add(
        "ex_multi",
        "SELECT CREW_INDICATOR, CREW_ID, TRANSACTION_CODE, DATE AS PAIRING_DATE, PAIRING_POSITION, BID_PERIOD, BASE,"
        f" 'NA' AS EQUIPMENT, PAIRING_NO, update_dt, name FROM {f}",
    )


def asn_days(s, p):
    one, many = ex_single(s, p), ex_multi(s, p)
    return s.add(
        "asn_days",
        f"SELECT {SILVER} FROM (SELECT {SILVER}, PAIRING_NO, update_dt, 0 AS src FROM {one}"
        f" UNION ALL SELECT {SILVER}, PAIRING_NO, update_dt, 1 AS src FROM {many}) u\n"
        + first_row(["PAIRING_DATE", "CREW_ID"], "src, PAIRING_NO NULLS LAST, update_dt NULLS LAST"),
    )


def j5(s, p):
    a, r = asn_days(s, p), m9(s, p)
    return s.add("j5", f"SELECT * FROM {a} x WHERE EXISTS (SELECT 1 FROM {r} z WHERE {nsj('z', 'x', MATCH)})")


def j4(s, p):
    a, r = asn_days(s, p), m9(s, p)
    return s.add("j4", f"SELECT * FROM {a} x WHERE NOT EXISTS (SELECT 1 FROM {r} z WHERE {nsj('z', 'x', MATCH)})")


def x4(s, p):
    f, ov = ex_multi(s, p), w4(s, p)
    if p.literal_fill:  # the first days go before the fill
        later = s.add("ex_later", "SELECT * FROM ex_pad_padded WHERE name = 'TO_DATE' OR name IS NULL")
        cols = [*EX_PAD, "DATE", *(c for c in ASN_CARRY if c not in EX_PAD), "name"]
        fill = s.add("ex_later_filled", "SELECT " + fill_all(later, cols, EX_PAD, FIRST))
        f = s.add("ex_later_days", f"SELECT * EXCLUDE (DATE), DATE AS PAIRING_DATE, 'NA' AS EQUIPMENT FROM {fill}")
    return s.add(
        "x4",
        f"SELECT * FROM {f} x WHERE (name = 'TO_DATE' OR name IS NULL) AND {not_in_days('x', ov)}",
    )


def j7(s, p):
    r, c = m9(s, p), x4(s, p)
    return s.add(
        "j7",
        f"SELECT * FROM {r} x WHERE {not_in_days('x', c, ('CREW_ID', 'PAIRING_DATE', 'BASE', 'CREW_INDICATOR'))}\n"
        + first_row(["PAIRING_DATE", "CREW_ID"]),
    )


def m11(s, p):
    a, b = j7(s, p), j5(s, p)
    return s.add("m11", f"SELECT {SILVER} FROM {a} UNION ALL SELECT {SILVER} FROM {b}")


def m1(s, p):
    r = m11(s, p)
    return s.add(
        "m1",
        "SELECT PAIRING_DATE, BASE, RLV, ASN, round_even(ASN * 100 / NULLIF(RLV, 0), 0) AS perc_utl FROM (\n"
        "SELECT PAIRING_DATE, BASE, count(*) FILTER (WHERE code = 'RLV') AS RLV, count(*) FILTER (WHERE code = 'ASN') AS ASN\n"
        f"FROM (SELECT *, CASE WHEN TRANSACTION_CODE = 'RSV' THEN 'RLV' ELSE TRANSACTION_CODE END AS code FROM {r}"
        f" WHERE BASE = {q(P.REPORT_BASE)}) x GROUP BY PAIRING_DATE, BASE) g",
    )


# --- gold ------------------------------------------------------------------


def utilization_fa(s: Sql, silver: str) -> str:
    return s.add(
        "gold_fa",
        "SELECT 'FA' AS PAIRING_POSITION, PAIRING_DATE, BASE, 'NA' AS EQUIPMENT, ASN, RLV_SCR,"
        " round((ASN / RLV_SCR) * 100, 2) AS PERCENT_UTILIZATION FROM (\n"
        "SELECT PAIRING_DATE, BASE, count(*) FILTER (WHERE TRANSACTION_CODE = 'ASN') AS ASN,"
        " count(*) FILTER (WHERE TRANSACTION_CODE = 'RLV') AS RLV_SCR\n"
        f"FROM {silver} GROUP BY PAIRING_DATE, BASE) g WHERE RLV_SCR > 0",
    )


def utilization_pilot(s: Sql, p: P.RunParams, silver: str) -> str:
    return s.add(
        "gold_pilot",
        "SELECT PAIRING_POSITION, PAIRING_DATE, BASE, EQUIPMENT, ASN, RLV_SCR,"
        " round((ASN / RLV_SCR) * 100, 2) AS PERCENT_UTILIZATION FROM (\n"
        "SELECT BASE, PAIRING_DATE, PAIRING_POSITION, EQUIPMENT, count(*) FILTER (WHERE TRANSACTION_CODE = 'ASN') AS ASN,"
        " count(*) FILTER (WHERE TRANSACTION_CODE IN ('SCR', 'ARC')) AS RLV_SCR\n"
        f"FROM {silver} GROUP BY BASE, PAIRING_DATE, PAIRING_POSITION, EQUIPMENT) g\n"
        f"WHERE RLV_SCR > 0 AND NOT (PAIRING_DATE < {d(p.flag_date)} AND EQUIPMENT = '789')",
    )


# --- registry ----------------------------------------------------------------


def _one(build) -> str:
    s = Sql()
    final = build(s)
    return s.render(final)


def queries(p: P.RunParams = P.DEFAULT) -> dict[str, str]:
    out: dict[str, str] = {}

    def reg(name, build):
        out[name] = _one(build)

    reg("fa_backfill", lambda s: f"SELECT * FROM {fa_silver(s, p, True)}")
    reg("fa_incremental", lambda s: f"SELECT * FROM {fa_silver(s, p, False)}")
    reg("utilization_fa", lambda s: f"SELECT * FROM {utilization_fa(s, fa_silver(s, p, True))}")
    reg("schedule_latest", lambda s: f"SELECT * FROM {sched_latest(s, p, False)}")
    reg("pilot_backfill", lambda s: f"SELECT * FROM {pilot_silver(s, p, True)}")
    reg("pilot_incremental", lambda s: f"SELECT * FROM {pilot_silver(s, p, False)}")
    reg("utilization_pilot", lambda s: f"SELECT * FROM {utilization_pilot(s, p, pilot_silver(s, p, True))}")
    reg("available_reserve", lambda s: f"SELECT {SILVER} FROM {m9(s, p)}")
    reg("paid_assignments", lambda s: f"SELECT * EXCLUDE (TXN_SEQ) FROM {m10(s, p)}")
    reg("released_after_reserve", lambda s: f"SELECT * FROM {w3(s, p)}")
    reg("overlap_days", lambda s: f"SELECT * FROM {w4(s, p)}")
    reg("released_after_asn", lambda s: f"SELECT * FROM {w5(s, p)}")
    reg("last_position", lambda s: f"SELECT DISTINCT CREW_ID, PAIRING_DATE, CAST(last_rlv_pos AS INT) AS last_rlv_pos FROM {ex_flag(s, p)} WHERE last_rlv_pos IS NOT NULL")
    reg("asn_without_reserve", lambda s: f"SELECT * FROM {j4(s, p)}")
    reg("asn_with_reserve", lambda s: f"SELECT * FROM {j5(s, p)}")
    reg("carried_days", lambda s: f"SELECT {SILVER} FROM {x4(s, p)}")
    reg("reserve_minus_carried", lambda s: f"SELECT {SILVER} FROM {j7(s, p)}")
    reg("reconciled_days", lambda s: f"SELECT * FROM {m11(s, p)}")
    reg("utilization_hnl", lambda s: f"SELECT * FROM {m1(s, p)}")
    # evident-intent options
    p_asn = p.with_(asn_rows_only=True)
    reg("fa_incremental_asn_rows_only", lambda s: f"SELECT * FROM {fa_silver(s, p_asn, False)}")
    p_arc = p.with_(fold_arc_in_backfill=True)
    reg("pilot_backfill_arc_folded", lambda s: f"SELECT * FROM {pilot_silver(s, p_arc, True)}")
    p_cut = p.with_(pilot_cutoff_day=21)
    reg("pilot_incremental_cutoff", lambda s: f"SELECT * FROM {pilot_silver(s, p_cut, False)}")
    reg("available_reserve_running", lambda s: m9_running(s, p))
    reg("running_releases", lambda s: f"SELECT * FROM {w6(s, p)}")
    p_lit = p.with_(literal_fill=True)
    reg("fa_backfill_literal_fill", lambda s: f"SELECT * FROM {fa_silver(s, p_lit, True)}")
    reg("fa_incremental_literal_fill", lambda s: f"SELECT * FROM {fa_silver(s, p_lit, False)}")
    reg("pilot_backfill_literal_fill", lambda s: f"SELECT * FROM {pilot_silver(s, p_lit, True)}")
    reg("carried_days_literal_fill", lambda s: f"SELECT {SILVER} FROM {x4(s, p_lit)}")
    reg("reconciled_days_literal_fill", lambda s: f"SELECT * FROM {m11(s, p_lit)}")

    def wrap_times(s):
        lo, hi = p.bounds(p.pilot_window)
        secs = lambda c: f"(epoch(CAST({c} AS TIME)))"
        src = s.add(
            "wrap_rows",
            "SELECT *, CAST((TO_SECS - FROM_SECS + 86400) % 86400 AS INT) AS wrap_dif FROM (SELECT *, UPDATE_TIME AS FROM_TIME,"
            f" {secs('UPDATE_TIME')} AS FROM_SECS, CASE WHEN TXN_SEQ % 101 <> 0 THEN ({secs('UPDATE_TIME')} + 1800 * (TXN_SEQ % 48)) % 86400 END AS TO_SECS"
            f" FROM {window(s, 'wrap_win', lo, hi)} WHERE TRANSACTION_CODE IN ('ARC', 'SCR') AND PAIRING_NO IS NULL) x",
        )
        top = s.add(
            "wrap_top",
            f"SELECT CREW_ID, PAIRING_DATE, max(wrap_dif) AS top FROM {src} GROUP BY CREW_ID, PAIRING_DATE HAVING count(*) = count(wrap_dif)",
        )
        tied = s.add(
            "wrap_tied",
            f"SELECT x.*, {STAMP} AS update_dt FROM {src} x JOIN {top} t ON {nsj('x', 't', DAYK)} AND wrap_dif = top",
        )
        return (
            "SELECT CREW_ID, PAIRING_DATE, FROM_TIME, CAST(TIME '00:00:00' + to_seconds(CAST(TO_SECS AS BIGINT)) AS VARCHAR) AS TO_TIME,"
            f" TRANSACTION_CODE FROM {tied} " + first_row(["CREW_ID", "PAIRING_DATE", "TRANSACTION_CODE"])
        )

    reg("wrap_times", wrap_times)
    # sources and parameters
    lo_p, hi_p = p.bounds(p.pilot_window)
    reg("scan_window_by_catalogue", lambda s: f"SELECT * FROM {window(s, 'p_win', lo_p, hi_p)}")
    reg("bid_periods_by_partition", lambda s: f"SELECT DISTINCT BID_PERIOD FROM {bid_scan(s, p)} ORDER BY BID_PERIOD DESC")
    lo_fa, hi_fa = p.bounds(p.fa_window)
    reg("scan_window", lambda s: f"SELECT * FROM {window(s, 'fa_win', lo_fa, hi_fa)}")
    reg("scan_bid_period", lambda s: f"SELECT * FROM {bid_scan(s, p)}")
    reg("bid_periods", lambda s: f"SELECT DISTINCT BID_PERIOD FROM {bid_scan(s, p)} ORDER BY BID_PERIOD DESC")
    blo, bhi = p.pilot_bid_range
    reg("schedule_scan", lambda s: f"SELECT * FROM {sched(s)} WHERE BID_DATE BETWEEN {q(blo)} AND {q(bhi)}")
    reg(
        "cutoff_incremental",
        lambda s: "SELECT run_date, strftime(date_trunc('month', run_date + "
        f"{p.cutoff_lead_days}) - INTERVAL 1 DAY, '%Y-%m') || '-{p.incremental_cutoff_day:02d} 00:00:00' AS cutoff"
        f" FROM (SELECT DISTINCT PAIRING_DATE AS run_date FROM {txn(s)}) r",
    )
    reg(
        "cutoff_backfill",
        lambda s: f"SELECT BID_PERIOD, {fa_cutoff(p, True)} AS cutoff FROM (SELECT DISTINCT BID_PERIOD FROM {txn(s)}) b",
    )
    # filters
    reg("not_placeholder_crew", lambda s: f"SELECT * FROM {txn(s)} WHERE CREW_ID IS NULL OR CREW_ID NOT IN {inlist(P.PLACEHOLDER_CREW_IDS)}")
    reg("equipment_exclusion", lambda s: f"SELECT * FROM {sched(s)} WHERE EQUIPMENT <> '33Y'")

    def group_any(s):
        w = window(s, "fa_win", lo_fa, hi_fa)
        rows = s.add("ga_rows", f"SELECT *, {STAMP} AS update_dt FROM {w} WHERE CREW_INDICATOR = 'FA'")
        return (
            f"SELECT * FROM {rows} x WHERE EXISTS (SELECT 1 FROM {rows} z WHERE z.TRANSACTION_CODE = 'ASN'"
            f" AND {nsj('z', 'x', DAYK)})"
        )

    reg("group_any", group_any)

    def group_reject(s):
        ex_flag(s, p)
        rows = "ex_rows"
        return (
            f"SELECT * FROM {rows} x WHERE NOT EXISTS (SELECT 1 FROM {rows} z WHERE z.TRANSACTION_CODE IN {inlist(P.RELEASE_CODES)}"
            f" AND {nsj('z', 'x', DAYK)})"
        )

    reg("group_reject", group_reject)

    def latest_ties(s):
        sc = sched(s)
        return (
            f"SELECT * EXCLUDE (top_dt) FROM (SELECT *, {STAMP} AS update_dt, max({STAMP}) OVER (PARTITION BY CREW_ID,"
            " EFFECTIVE_FROM_DATE, EFFECTIVE_TO_DATE, PAIRING_POSITION) AS top_dt FROM "
            f"{sc} WHERE BID_DATE BETWEEN {q(blo)} AND {q(bhi)}) x WHERE update_dt = top_dt"
        )

    reg("latest_ties", latest_ties)
    p_intent = p.with_(flag_date_intent=True)
    reg("equipment_date_rule", lambda s: f"SELECT * FROM {pilot_silver(s, p_intent, True)}")
    # joins
    reg("schedule_inner", lambda s: f"SELECT * FROM {pilot_reserve(s, p, False)}")
    reg("schedule_left", lambda s: f"SELECT * FROM {pilot_reserve(s, p, True)}")
    allc = SILVER.split(", ")

    def guard(s):
        inc, bf = fa_silver(s, p, False), fa_silver(s, p, True)
        return f"SELECT * FROM {inc} x WHERE NOT EXISTS (SELECT 1 FROM {bf} z WHERE {nsj('z', 'x', allc)})"

    reg("append_guard", guard)
    # dedup, counts, reshape
    reg("first_per_key", lambda s: f"SELECT {SILVER} FROM {fa_reserve(s, p, False)}")

    def distinct_crew_day(s):
        lo, hi = p.bounds(p.explore_window)
        w = window(s, "ex_win", lo, hi)
        fa_rows = s.add("dcd_rows", f"SELECT * FROM {w} WHERE CREW_INDICATOR = 'FA'")
        return (
            f"SELECT DISTINCT CREW_ID, PAIRING_DATE FROM {fa_rows} x WHERE EXISTS (SELECT 1 FROM {fa_rows} z"
            f" WHERE z.TRANSACTION_CODE IN {inlist(P.FA_RESERVE_CODES)} AND z.CREW_ID IS NOT DISTINCT FROM x.CREW_ID)"
            f" AND (CREW_ID IS NULL OR CREW_ID NOT IN {inlist(P.PLACEHOLDER_CREW_IDS)})"
        )

    reg("distinct_crew_day", distinct_crew_day)
    reg(
        "daily_counts",
        lambda s: "SELECT PAIRING_DATE, code AS TRANSACTION_CODE, BASE, count(*) AS n FROM (SELECT *, CASE WHEN TRANSACTION_CODE = 'RSV'"
        f" THEN 'RLV' ELSE TRANSACTION_CODE END AS code FROM {m11(s, p)}) x GROUP BY PAIRING_DATE, code, BASE",
    )
    reg(
        "unpivot_dates",
        lambda s: "SELECT * FROM (\n"
        + unpivot_ends(m10(s, p), ("CREW_INDICATOR", "CREW_ID", "TRANSACTION_CODE", "PAIRING_NO", "PAIRING_POSITION", "BID_PERIOD", "BASE", "update_dt"))
        + "\n) u",
    )
    reg(
        "pivot_codes",
        lambda s: "SELECT PAIRING_DATE, BASE, count(*) FILTER (WHERE TRANSACTION_CODE = 'RLV') AS RLV,"
        f" count(*) FILTER (WHERE TRANSACTION_CODE = 'ASN') AS ASN FROM {fa_silver(s, p, True)} GROUP BY PAIRING_DATE, BASE",
    )
    # expansion, fill, union, alignment
    reg("expand_single", lambda s: f"SELECT * FROM {fa_single(s, p, True)}")
    reg("expand_multi", lambda s: f"SELECT * FROM {fa_multi(s, p, True)}")

    def pad_days(s):
        fa_multi_filled(s, p, True)
        return (
            "SELECT BID_PERIOD, CREW_ID, BASE, PAIRING_NO, DATE, name, CREW_INDICATOR, TRANSACTION_CODE, PAIRING_POSITION"
            " FROM fa_pad_bf_padded"
        )

    reg("pad_days", pad_days)
    reg("fill_down", lambda s: f"SELECT * FROM {pilot_multi(s, p, True)}")
    reg("union_silver", lambda s: f"SELECT * FROM {fa_silver(s, p, True)} UNION ALL SELECT * FROM {pilot_silver(s, p, True)}")
    reg(
        "align_columns",
        lambda s: f"SELECT CREW_INDICATOR, CREW_ID, TRANSACTION_CODE, PAIRING_DATE, PAIRING_POSITION, BID_PERIOD, BASE FROM {m10(s, p)}",
    )

    # table lifecycle
    def table0(s):
        return s.add("table0", f"SELECT * FROM {fa_silver(s, p, True)} UNION ALL SELECT * FROM {pilot_silver(s, p, True)}")

    def append_batch(s):
        t0, b = table0(s), pilot_silver(s, p, False)
        return f"SELECT * FROM {b} x WHERE NOT EXISTS (SELECT 1 FROM {t0} z WHERE {nsj('z', 'x', allc)})"

    reg("append_batch", append_batch)
    def added(s):
        return f"SELECT * FROM {fa_silver(s, p, False)} x WHERE NOT EXISTS (SELECT 1 FROM {fa_silver(s, p, True)} z WHERE {nsj('z', 'x', allc)})"

    reg("named_table_roundtrip", lambda s: f"SELECT * FROM {fa_silver(s, p, True)} UNION ALL ({added(s)})")
    reg(
        "rows_added",
        lambda s: f"SELECT '1 backfill' AS run, count(*) AS rows FROM {fa_silver(s, p, True)}"
        f" UNION ALL SELECT '2 append', count(*) FROM ({added(s)}) a UNION ALL SELECT '3 append again', 0",
    )
    reg("table_periods", lambda s: f"SELECT DISTINCT BID_PERIOD FROM {table0(s)}")
    reg(
        "group_ids",
        lambda s: "SELECT TXN_SEQ, CREW_ID, PAIRING_DATE, TRANSACTION_CODE, dense_rank() OVER (ORDER BY CREW_ID NULLS LAST,"
        f" PAIRING_DATE NULLS LAST, TRANSACTION_CODE NULLS LAST) AS temp_id FROM {window(s, 'fa_win', lo_fa, hi_fa)}"
        f" WHERE CREW_INDICATOR = 'FA' AND TRANSACTION_CODE IN {inlist(P.FA_RESERVE_CODES)}",
    )
    reg("overwrite_roundtrip", lambda s: f"SELECT * FROM {fa_silver(s, p, True)}")

    def append_roundtrip(s):
        t0, fi, pi = table0(s), fa_silver(s, p, False), pilot_silver(s, p, False)
        a1 = s.add("add_fa", f"SELECT * FROM {fi} x WHERE NOT EXISTS (SELECT 1 FROM {t0} z WHERE {nsj('z', 'x', allc)})")
        t1 = s.add("table1", f"SELECT * FROM {t0} UNION ALL SELECT * FROM {a1}")
        a2 = s.add("add_p", f"SELECT * FROM {pi} x WHERE NOT EXISTS (SELECT 1 FROM {t1} z WHERE {nsj('z', 'x', allc)})")
        return f"SELECT * FROM {t1} UNION ALL SELECT * FROM {a2}"

    reg("append_roundtrip", append_roundtrip)
    return out
