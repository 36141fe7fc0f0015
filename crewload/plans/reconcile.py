"""Order-aware reconciliation of reserve and assignment days.

Per crew and day the log is read in update order:

* a reserve day is void when a release code follows its last reserve code
  (W3);
* an assignment is void when an assignment release follows its last ASN
  (W5);
* a day has an overlap when an overlap code follows its last reserve or
  assignment code (W4).

All three come from one hash aggregate per (crew, day) over fixed-width sort
keys (see ``operators.groups``); the first row of each reserve code and of
ASN is a top-1 before the shuffle. The two meet in one staged table that all
later steps read. Assignment days count only when the crew was on reserve that
day (J5); reserve days after the first day of a multi-day trip are removed
unless the day has an overlap (X4, J7).

Every join of these steps compares rows of one crew and day. So the claims
and the trip days are stacked, shuffled once on (crew, day), and each join is
a flag over a window that the shuffle already serves: windows group NULL keys
together, as the source's joins do, and need no second hash of encoded keys.
A (crew, day) holds at most one row per code and trip, so no group is large
however hot the crew or day is in the log.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions.predicates import not_in_keep_null
from ..operators.dedup import first_per_key
from ..operators.expand import DATE, NAME, carried_days, expand_multi, expand_single, fill_literal
from ..operators.groups import after, group_flags, last_key, last_position, sort_key
from ..operators.joins import anti_join, join_null_safe, semi_join
from ..operators.reshape import union_by_name
from ..sources.history import Log, scan_window
from .common import ASN_COLS, FILL_COLS, SEQ, STAMP, first_order, lit_equipment, silver, stage, with_stamp
from .utilization import utilization_live

DAY = ["CREW_ID", "PAIRING_DATE"]
CLAIM_CODES = P.FA_RESERVE_CODES + (P.ASSIGNMENT_CODE,)
MATCH_COLS = ["CREW_INDICATOR", "CREW_ID", "PAIRING_DATE", "PAIRING_POSITION", "BID_PERIOD", "BASE", "EQUIPMENT"]
CARRY_KEYS = ["CREW_ID", "PAIRING_DATE", "BASE", "CREW_INDICATOR"]
DAY_KEYS = ["CREW_ID", "TRANSACTION_CODE", DATE, "PAIRING_NO"]
PAD_KEYS = ["CREW_ID", "PAIRING_NO", STAMP]


def explore_rows(history: Log, params: P.RunParams = P.DEFAULT) -> DataFrame:
    """FA rows of the analysis window, placeholder crews removed (NULL kept)."""
    lo, hi = params.bounds(params.explore_window)
    rows = scan_window(history, lo, hi).where(
        (F.col("CREW_INDICATOR") == P.FA) & not_in_keep_null("CREW_ID", P.PLACEHOLDER_CREW_IDS)
    )
    return with_stamp(rows)


PAYLOAD = [*ASN_COLS, SEQ]


def day_flags(rows: DataFrame) -> DataFrame:
    """One row per (crew, day) with the three day flags.

    A hash aggregate (partial per task, then one shuffle on crew and day)
    replaces the source's per-group sort: the flags compare the sort keys of
    the last rows of each code set.
    """
    agg = group_flags(
        rows,
        DAY,
        {
            "last_reserve": last_key(P.FA_RESERVE_CODES),
            "last_release": last_key(P.RELEASE_CODES),
            "last_claim": last_key(CLAIM_CODES),
            "last_overlap": last_key(P.OVERLAP_CODES),
            "last_asn": last_key((P.ASSIGNMENT_CODE,)),
            "last_asn_release": last_key(P.ASSIGNMENT_RELEASE_CODES),
        },
    )
    has_reserve = F.col("last_reserve").isNotNull()
    return agg.select(
        *DAY,
        (has_reserve & after(F.col("last_release"), F.col("last_reserve"))).alias("released_reserve"),
        (has_reserve & after(F.col("last_overlap"), F.col("last_claim"))).alias("overlap"),
        after(F.col("last_asn_release"), F.col("last_asn")).alias("released_asn"),
    )


def day_claims(rows: DataFrame, flags: DataFrame) -> DataFrame:
    """The first row of each reserve code and of ASN per (crew, day), with
    the flags of its day.

    The first rows are a top-1 per key before the shuffle, as in the silver
    plans. They are stacked with the flags and meet them in a window over
    (crew, day), at most four rows a group: one exchange where a null-safe
    join has two.
    """
    firsts = first_per_key(rows.where(F.col("TRANSACTION_CODE").isin(*CLAIM_CODES)), [*DAY, "TRANSACTION_CODE"], first_order())
    both = firsts.select(*PAYLOAD).unionByName(flags, allowMissingColumns=True)
    day = Window.partitionBy(*DAY)
    found = [F.max(c).over(day).alias(c) for c in flags.columns if c not in DAY]
    return both.select(*PAYLOAD, *found).where(F.col("TRANSACTION_CODE").isNotNull())


def running_releases(rows: DataFrame) -> DataFrame:
    """(crew, day) of the days with an RLV row, and ``released``: whether
    some row, with an RLV row at or before it, directly follows a release.

    The source carries a running "RLV seen" flag and a lag through each sorted
    group. Only two rows decide: a release after the first RLV that is not
    the last row has a successor, for which RLV was seen; and a release right
    before the first RLV has that RLV as successor. So two hash aggregates
    over sort keys replace the running state, the first one's single row per
    group being joined back (AQE splits a hot group): nothing is sorted or
    held by group.
    """
    keyed = rows.select(*DAY, sort_key().alias("__k"), F.col("TRANSACTION_CODE").alias("__c"))
    release, rlv = F.col("__c").isin(*P.ASSIGNMENT_RELEASE_CODES), F.col("__c") == P.RUNNING_CODE
    ends = group_flags(
        keyed,
        DAY,
        {"__first": F.min(F.when(rlv, F.col("__k"))), "__last": F.max("__k"), "__any": F.max(F.coalesce(release, F.lit(False)))},
    ).where(F.col("__first").isNotNull())
    days = ends.select(*DAY)
    near = join_null_safe(keyed, ends.where("__any").drop("__any"), DAY)
    k, first, last = F.col("__k"), F.col("__first"), F.col("__last")
    hit = group_flags(
        near,
        DAY,
        {
            "__inside": F.max(F.coalesce(release & (k > first) & (k < last), F.lit(False))),
            "__before": F.max(F.when(k < first, k)),
            "__release": F.max(F.when(release & (k < first), k)),
        },
    )
    released = F.col("__inside") | F.coalesce(F.col("__before") == F.col("__release"), F.lit(False))
    hit = hit.where(released).select(*DAY, F.lit(True).alias("released"))
    return join_null_safe(days, hit, DAY, "left").na.fill(False, ["released"])


def with_running_release(claims: DataFrame, rows: DataFrame) -> DataFrame:
    """Claims whose reserve rows are judged by W6 instead of W3: days without
    an RLV row give no reserve, as in that variant."""
    judged = running_releases(rows).withColumnRenamed("released", "__released")
    joined = join_null_safe(claims, judged, DAY, "left")
    return joined.withColumn("released_reserve", F.coalesce("__released", F.lit(True))).drop("__released")


def released_after_reserve(flags: DataFrame) -> DataFrame:
    """Reserve days given back after their last reserve code."""
    return flags.where(F.col("released_reserve")).select(*DAY)


def overlap_days(flags: DataFrame) -> DataFrame:
    """Reserve days with an overlap code after the last claim code."""
    return flags.where(F.col("overlap")).select(*DAY)


def released_after_asn(flags: DataFrame) -> DataFrame:
    """Days with an assignment release after the last ASN (any release
    when the day has no ASN)."""
    return flags.where(F.col("released_asn")).select(*DAY)


def reserve_position(rows: DataFrame) -> DataFrame:
    """1-based position of the last reserve code of each reserve day."""
    return last_position(rows, DAY, P.FA_RESERVE_CODES, "last_rlv_pos").where(F.col("last_rlv_pos").isNotNull())


def available_reserve(claims: DataFrame) -> DataFrame:
    """M9: first row per (crew, day, code) of reserve days not given back."""
    rsv = claims.where(F.col("TRANSACTION_CODE").isin(*P.FA_RESERVE_CODES) & ~F.col("released_reserve"))
    return lit_equipment(
        rsv.select("CREW_INDICATOR", "CREW_ID", "TRANSACTION_CODE", "PAIRING_DATE", "PAIRING_POSITION", "BID_PERIOD", "BASE", STAMP, SEQ),
        P.FA_EQUIPMENT,
    )


def paid_assignments(claims: DataFrame) -> DataFrame:
    """First ASN row per (crew, day) of assignments not given back."""
    return claims.where((F.col("TRANSACTION_CODE") == P.ASSIGNMENT_CODE) & ~F.col("released_asn")).select(*PAYLOAD)


def assignment_single(paid: DataFrame) -> DataFrame:
    """X2 on paid assignments (one per crew and day already, so the
    single-day key is unique and its dedup is skipped)."""
    return lit_equipment(expand_single(paid, DAY_KEYS, first_order(), input_unique=True), P.FA_EQUIPMENT)


def assignment_expanded(paid: DataFrame, literal: bool = False) -> DataFrame:
    """X1 on paid assignments, NAME kept; the fill stays inside each trip,
    unless ``literal`` (N8)."""
    out = expand_multi(paid, DAY_KEYS, PAD_KEYS, first_order(), () if literal else FILL_COLS)
    if literal:
        out = fill_literal(out, PAD_KEYS, first_order(), FILL_COLS)
    return lit_equipment(out.withColumnRenamed(DATE, "PAIRING_DATE"), P.FA_EQUIPMENT)


def carried_literal(paid: DataFrame) -> DataFrame:
    """X4's days as the source fills them (N7): the first day of each trip is
    removed before the fill, so an inserted day takes the row above it, which
    may be the last day of another trip."""
    days = carried_days(expand_multi(paid, DAY_KEYS, PAD_KEYS, first_order(), ()))
    out = fill_literal(days, PAD_KEYS, first_order(), FILL_COLS)
    return lit_equipment(out.withColumnRenamed(DATE, "PAIRING_DATE"), P.FA_EQUIPMENT)


def assignment_days(paid: DataFrame, expanded: DataFrame) -> DataFrame:
    """First assignment row per (crew, day): single-day trips before
    multi-day ones, then by pairing number and stamp (one row per trip and
    day, so the order is total)."""
    single = assignment_single(paid).withColumn("__src", F.lit(0))
    multi = expanded.withColumn("__src", F.lit(1))
    cols = [*P.SILVER_COLUMNS, "PAIRING_NO", STAMP, "__src"]
    both = union_by_name(single.select(*cols), multi.select(*cols))
    order = [F.col("__src").asc(), F.col("PAIRING_NO").asc_nulls_last(), F.col(STAMP).asc_nulls_last()]
    return first_per_key(both, ["PAIRING_DATE", "CREW_ID"], order).select(*P.SILVER_COLUMNS)


def asn_without_reserve(days: DataFrame, available: DataFrame) -> DataFrame:
    """Assignment days with no matching reserve day (7 columns)."""
    return anti_join(days, available.select(*MATCH_COLS), MATCH_COLS)


def asn_with_reserve(days: DataFrame, available: DataFrame) -> DataFrame:
    """Assignment days that match a reserve day; the source's anti join
    of the anti join is exactly this semi join."""
    return semi_join(days, available.select(*MATCH_COLS), MATCH_COLS)


def carried(expanded: DataFrame, claims: DataFrame) -> DataFrame:
    """Days after the first of each multi-day trip, except overlap days
    (these have a reserve row, so the claims show them all)."""
    return anti_join(carried_days(expanded), overlap_days(claims), DAY)


def reserve_minus_carried(available: DataFrame, carried_rows: DataFrame) -> DataFrame:
    """J7 + D1: reserve days not covered by a carried trip day, one per
    (crew, day), earliest reserve row first."""
    kept = anti_join(available, carried_rows, CARRY_KEYS)
    return first_per_key(kept, ["PAIRING_DATE", "CREW_ID"], first_order())


def day_rows(claims: DataFrame, expanded: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """Claims and trip days stacked, with the outcome of every join as a flag.
    ``carried``: the trip days after the first, where they are other rows
    than those of ``expanded`` (literal fill).

    ``is_reserve`` / ``is_asn`` tell the kinds, ``on_reserve`` (J4, J5)
    whether an available reserve row matches on all seven columns,
    ``carried`` (X4, J6) a trip day after the first without an overlap,
    ``covered`` (J7) whether such a day matches on its four columns, and
    ``nth`` the place among the day's assignment rows, or among its reserve
    rows that are not covered (D1). One exchange, on (crew, day).
    """
    code = F.col("TRANSACTION_CODE")
    reserve = code.isin(*P.FA_RESERVE_CODES) & ~F.col("released_reserve")
    single = (code == P.ASSIGNMENT_CODE) & ~F.col("released_asn") & (F.col("PAIRING_DATE") == F.col("TO_DATE"))
    cols = [*(c for c in P.SILVER_COLUMNS if c != "EQUIPMENT"), "PAIRING_NO", STAMP, SEQ]
    yes, no = F.lit(True), F.lit(False)
    later = (F.col(NAME) == "TO_DATE") | F.col(NAME).isNull()
    rows = union_by_name(
        claims.select(
            *cols, F.coalesce(reserve, no).alias("is_reserve"), F.coalesce(single, no).alias("is_asn"),
            F.lit(0).alias("__src"), no.alias("__later"), F.coalesce("overlap", no).alias("__overlap"),
        ),
        expanded.select(
            *cols, no.alias("is_reserve"), yes.alias("is_asn"),
            F.lit(1).alias("__src"), (later if carried is None else no).alias("__later"), no.alias("__overlap"),
        ),
    )
    if carried is not None:
        flags = {"is_reserve": no, "is_asn": no, "__src": F.lit(2), "__later": yes, "__overlap": no}
        rows = rows.unionByName(carried.select(*cols, *(c.alias(n) for n, c in flags.items())))
    rows = lit_equipment(rows, P.FA_EQUIPMENT)
    day, carry, match = (Window.partitionBy(*keys) for keys in (DAY, CARRY_KEYS, MATCH_COLS))
    rows = rows.withColumn("carried", F.col("__later") & ~F.max("__overlap").over(day))
    rows = rows.withColumn("covered", F.max("carried").over(carry)).withColumn("on_reserve", F.max("is_reserve").over(match))
    kind = F.when(F.col("is_asn"), 1).when(F.col("is_reserve") & ~F.col("covered"), 2)
    asn_order = [F.col("__src"), F.when(F.col("is_asn"), F.col("PAIRING_NO")).asc_nulls_last()]
    nth = F.row_number().over(Window.partitionBy(*DAY, "__kind").orderBy(*asn_order, *first_order()))
    return rows.withColumn("__kind", kind).withColumn("nth", nth).drop("__kind", "__src", "__later", "__overlap")


class Reconciled:
    """The steps of the reconciliation, each built when it is asked for. The
    claims and the expanded trips feed several branches with different
    columns, so each is staged once instead of being shuffled per branch."""

    def __init__(self, rows: DataFrame, params: P.RunParams = P.DEFAULT):
        self.rows, self.params = rows, params

    @cached_property
    def flags(self) -> DataFrame:
        return day_flags(self.rows)

    @cached_property
    def claims(self) -> DataFrame:
        claims = day_claims(self.rows, self.flags)
        if self.params.running_release:
            claims = with_running_release(claims, self.rows)
        return stage(claims, "claims")

    @cached_property
    def expanded(self) -> DataFrame:
        return stage(assignment_expanded(self.paid, self.params.literal_fill), "trip-days")

    @cached_property
    def day_rows(self) -> DataFrame:
        carried = stage(carried_literal(self.paid), "carried-days") if self.params.literal_fill else None
        return day_rows(self.claims, self.expanded, carried)

    @property
    def available(self) -> DataFrame:
        return available_reserve(self.claims)

    @property
    def paid(self) -> DataFrame:
        return paid_assignments(self.claims)

    @property
    def days(self) -> DataFrame:
        return silver(self.day_rows.where(F.col("is_asn") & (F.col("nth") == 1)))

    @property
    def carried(self) -> DataFrame:
        return self.day_rows.where(F.col("carried"))

    @property
    def reserve(self) -> DataFrame:
        return self.day_rows.where(F.col("is_reserve") & ~F.col("covered") & (F.col("nth") == 1))

    @property
    def assigned(self) -> DataFrame:
        return silver(self.day_rows.where(F.col("is_asn") & (F.col("nth") == 1) & F.col("on_reserve")))

    @property
    def unassigned(self) -> DataFrame:
        return silver(self.day_rows.where(F.col("is_asn") & (F.col("nth") == 1) & ~F.col("on_reserve")))

    @property
    def result(self) -> DataFrame:
        """Reconciled reserve and assignment days (silver columns)."""
        kept = F.when(F.col("is_asn"), F.col("on_reserve")).otherwise(F.col("is_reserve") & ~F.col("covered"))
        return silver(self.day_rows.where((F.col("nth") == 1) & kept))


def reconcile(history: Log, params: P.RunParams = P.DEFAULT) -> Reconciled:
    return Reconciled(explore_rows(history, params), params)


def reconciled_days(history: Log, params: P.RunParams = P.DEFAULT) -> DataFrame:
    return reconcile(history, params).result


def utilization_hnl(history: Log, params: P.RunParams = P.DEFAULT) -> DataFrame:
    """M1: the live report, HNL only."""
    return utilization_live(reconciled_days(history, params), P.REPORT_BASE)
