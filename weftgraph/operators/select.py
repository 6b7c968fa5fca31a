"""R2: select the documents of every request in one join.

All three selection modes become a join of the documents with a small request
table on equality keys (criteria id, platform code, and the day for the day
modes) plus a residual range predicate.  The request side is broadcast only
when its row count, known from the requests, is under a fixed bound; the large
document side is then streamed through a hash join without a shuffle.  When
the documents are stored partitioned by ``criteria_id/platform/day`` the
equality keys also give dynamic partition pruning.

Ranges that share a criteria id would all meet its documents.  So where there are
more than a few requests they are cut into time bins, of a width of each range's own size (a
power of four), and the documents are keyed by criteria and bin, once for each
width in use: a document meets the requests around its time only, each of them once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.functions.expressions import PLATFORM_CODES, ROW_KEY_SEPARATOR, day_of_millis
from weftgraph.plans.broadcast import DEFAULT_MAX_BROADCAST_ROWS, size_checked_broadcast
from weftgraph.sources.requests import DAY_LIST, DAY_RANGE, MS_PER_DAY, TIMESTAMP_RANGE, request_sides


# Requests up to this number meet the documents of their criteria directly.
FEW_REQUESTS = 64
# A bin's width is 4^level ms, the first that cuts a range into at most ten bins.
BINS_PER_REQUEST = 10
BINS = ("_rlevel", "_rbin")


def _level_of(first: Column, last: Column) -> Column:
    """The width of a range's bins: 8 * 4^level is at least its length."""
    length = F.greatest(last - first, F.lit(0)).cast("double") + 1
    return F.greatest(F.lit(0), F.ceil(F.log2(length / 8) / 2)).cast("int")


def _bin_of(millis: Column, level: Column) -> Column:
    return F.floor(millis / F.pow(F.lit(4.0), level)).cast("bigint")


def bin_levels(requests: DataFrame, first: Column, last: Column) -> list[int]:
    """The widths in use among the ranges [first, last]: one for each power of four at most."""
    return sorted(r[0] for r in requests.select(_level_of(first, last)).distinct().collect() if r[0] is not None)


def binned_requests(ranges: DataFrame, first: Column, last: Column) -> DataFrame:
    """Each range once per bin that it touches (``_rlevel``, ``_rbin``); a range whose end is before its start has none."""
    at = ranges.withColumn("_rlevel", _level_of(first, last))
    bins = F.when(first <= last, F.sequence(_bin_of(first, F.col("_rlevel")), _bin_of(last, F.col("_rlevel"))))
    return at.withColumn("_rbin", F.explode(bins))


def binned_documents(docs: DataFrame, millis: Column, levels: list[int]) -> DataFrame:
    """Each document once per width in use, with its bin (``_level``, ``_bin``)."""
    level = F.explode(F.array(*[F.lit(i) for i in levels])) if len(levels) > 1 else F.lit(levels[0])
    return docs.withColumn("_level", level).withColumn("_bin", _bin_of(millis, F.col("_level")))


def in_day_bins(rows: DataFrame, requests: DataFrame, meets: list, n_requests: int | None,
                max_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows with a ``day`` and requests with their first and last day, both cut into bins; as they are where they meet by equal days."""
    if len(meets) == 1:
        return rows, requests
    first, last = (F.unix_millis(F.try_to_timestamp(F.col(f"_{c}"), F.lit("yyyyMMdd"))) for _, _, c in meets)
    levels = bin_levels(requests, first, last)
    if levels:
        rows = binned_documents(rows, F.unix_millis(F.try_to_timestamp("day", F.lit("yyyyMMdd"))), levels)
        requests = binned_requests(requests, first, last)
    known = None if n_requests is None else n_requests * BINS_PER_REQUEST
    return rows, size_checked_broadcast(requests, known, max_rows, count_if_unknown=False)


def select_documents(documents: DataFrame, normalized_requests: DataFrame, selection: str,
                     require_target: bool = True, request_rows: int | None = None,
                     max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, n_requests: int | None = None) -> DataFrame:
    """Documents of each request, tagged with its ``graph_id``.

    ``documents`` has the interaction columns (``criteria_id, platform, day,
    source…, timestamp, post_id``).  A document matching several requests
    appears once per request.  ``request_rows`` is an upper bound on the rows of
    the request table expanded by day and ``n_requests`` on its own rows, when
    the caller knows them.  Documents without a ``platform`` column belong to
    requests that name none.
    """
    docs = documents.where(F.col("target").isNotNull()) if require_target else documents
    if selection in (DAY_RANGE, DAY_LIST):
        side, meets, n_side = request_sides(normalized_requests, selection, request_rows, n_requests, max_rows)
        rd = side.select("graph_id", F.col("criteria_id").alias("_crit"), F.col("code").alias("_code"),
                         *[F.col(c).alias(f"_{c}") for _, _, c in meets])
        docs, rd = in_day_bins(docs, rd, meets, n_side, max_rows)
        cond = (docs["criteria_id"] == rd["_crit"]) & (docs["platform"] == rd["_code"])
        if BINS[0] in rd.columns:
            cond = cond & (docs["_level"] == rd["_rlevel"]) & (docs["_bin"] == rd["_rbin"])
        for op, of_doc, of_request in meets:
            cond = cond & F.expr(f"{of_doc} {op} _{of_request}")
        return docs.join(rd, cond, "inner").drop("_crit", "_code", *[f"_{c}" for _, _, c in meets], *BINS, "_level", "_bin")
    if selection == TIMESTAMP_RANGE:
        rq = normalized_requests.select(
            "graph_id", F.col("criteria_id").alias("_crit"), F.col("code").alias("_code"),
            F.col("from_ms").alias("_from"), F.col("to_ms").alias("_to"))
        levels = bin_levels(normalized_requests, F.col("from_ms"), F.col("to_ms")) if n_requests is None or n_requests > FEW_REQUESTS else []
        if levels:
            docs = binned_documents(docs, F.col("timestamp"), levels)
            rq = binned_requests(rq, F.col("_from"), F.col("_to"))
        bins = BINS_PER_REQUEST if levels else 1
        rq = size_checked_broadcast(rq, None if n_requests is None else n_requests * bins, max_rows)
        same_platform = rq["_code"].isNull()
        if "platform" in docs.columns:
            same_platform = same_platform | (docs["platform"] == rq["_code"])
        cond = ((docs["criteria_id"] == rq["_crit"]) & same_platform
                & (docs["timestamp"] >= rq["_from"]) & (docs["timestamp"] <= rq["_to"]))
        if levels:
            cond = cond & (docs["_level"] == rq["_rlevel"]) & (docs["_bin"] == rq["_rbin"])
        return docs.join(rq, cond, "inner").drop("_crit", "_code", "_from", "_to", *BINS, "_level", "_bin")
    raise ValueError(f"unknown selection {selection!r}")


# The pushed predicate has at most this many boxes (a criteria or a run of them, platforms, a time range): one per
# merged range while there are fewer, else neighbouring ranges share one.
MAX_BOXES = 200
# 0001-01-01 and 9999-12-31 UTC: day keys have eight digits, and an order, between them.
FIRST_MS, LAST_MS = -62_135_596_800_000, 253_402_214_400_000


@dataclass(frozen=True)
class Box:
    """Covers requests: criteria ids from ``first`` to ``last``, platform codes (None among them: every platform), times in ms.

    ``first_key`` and ``last_key`` bound the criteria as prefixes of row keys, whose order differs from that of the ids.
    """

    first: str
    last: str
    first_key: str
    last_key: str
    codes: frozenset
    lo: int
    hi: int


def merged_ranges(requests: list[dict]) -> dict[tuple, list[tuple[int, int]]]:
    """The requests' ranges by (criteria id, platform code or None), overlapping ones merged, in order."""
    by_key: dict[tuple, list] = {}
    for r in requests:
        lo, hi = int(r["from"]), int(r["to"])
        key = (str(r["criteria_id"]), PLATFORM_CODES.get(str(r.get("platform"))))
        by_key.setdefault(key, []).append((min(lo, hi), max(lo, hi)))  # reversed within a day still names that day
    out = {}
    for key, ranges in by_key.items():
        merged: list = []
        for lo, hi in sorted(ranges):
            if merged and lo <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
            else:
                merged.append((lo, hi))
        out[key] = merged
    return out


def any_of(predicates: list):
    """Their disjunction as a balanced tree, so that many of them don't nest deeply."""
    while len(predicates) > 1:
        predicates = [a | b for a, b in zip(predicates[::2], predicates[1::2])] + \
            (predicates[-1:] if len(predicates) % 2 else [])
    return predicates[0] if predicates else F.lit(False)


def boxes_of(requests: list[dict], limit: int = MAX_BOXES) -> list[Box]:
    """At most ``limit`` boxes that cover all requests: neighbours in (criteria, platform, time) share one when there are more."""
    ranges = [(criteria + ROW_KEY_SEPARATOR, code, lo, hi) for (criteria, code), found in merged_ranges(requests).items()
              for lo, hi in found]
    ranges.sort(key=lambda r: (r[0].encode(), r[1] or "", r[2]))
    n, out = len(ranges), []
    for i in range(min(n, limit)):
        part = ranges[i * n // min(n, limit):(i + 1) * n // min(n, limit)]
        ids = sorted((r[0].removesuffix(ROW_KEY_SEPARATOR) for r in part), key=str.encode)
        out.append(Box(ids[0], ids[-1], part[0][0], part[-1][0], frozenset(r[1] for r in part),
                       min(r[2] for r in part), max(r[3] for r in part)))
    return out


def request_boxes(normalized: DataFrame, limit: int = MAX_BOXES) -> list[Box]:
    """The same from a table of requests of any size, cut by Spark; only the boxes reach the driver."""
    key = F.concat("criteria_id", F.lit(ROW_KEY_SEPARATOR))
    ranges = normalized.where(F.col("criteria_id").isNotNull()).select(
        "criteria_id", key.alias("k"), "code", F.least("from_ms", "to_ms").alias("lo"),
        F.greatest("from_ms", "to_ms").alias("hi")).where("lo is not null").distinct()
    cut = ranges.withColumn("box", F.ntile(limit).over(Window.orderBy("k", "code", "lo")))
    rows = cut.groupBy("box").agg(F.min("criteria_id"), F.max("criteria_id"), F.min("k"), F.max("k"),
                                  F.collect_set(F.coalesce("code", F.lit(""))), F.min("lo"), F.max("hi")).collect()
    return [Box(r[1], r[2], r[3], r[4], frozenset(c or None for c in r[5]), r[6], r[7]) for r in sorted(rows)]


def time_bounds(lo: int, hi: int, selection: str, day_key: bool):
    """Documents within [lo, hi]: by timestamp and, where they are stored with day keys, by day (a day's margin)."""
    if selection == TIMESTAMP_RANGE:
        pred = F.col("timestamp").between(lo, hi)
        day = F.col("day")
        if day_key and lo - MS_PER_DAY >= FIRST_MS:
            pred = pred & (day.isNull() | (day >= day_of_millis(F.lit(lo - MS_PER_DAY))))
        if day_key and hi + MS_PER_DAY <= LAST_MS:
            pred = pred & (day.isNull() | (day <= day_of_millis(F.lit(hi + MS_PER_DAY))))
        return pred
    # Day bounds as foldable expressions: Catalyst folds them with the session
    # time zone, the same zone that made the day keys, and pushes the literal.
    return F.col("day").between(day_of_millis(F.lit(lo)), day_of_millis(F.lit(hi)))


def box_predicate(box: Box, selection: str, day_key: bool, as_range: bool = False):
    criteria = F.col("criteria_id")
    pred = criteria == box.first if box.first == box.last and not as_range else criteria.between(box.first, box.last)
    if selection != TIMESTAMP_RANGE:
        pred = pred & F.col("platform").isin(sorted(c or "" for c in box.codes))
    elif None not in box.codes:
        pred = pred & F.col("platform").isin(sorted(box.codes))
    return pred & time_bounds(box.lo, box.hi, selection, day_key)


def pushdown_predicate(boxes: list[Box], selection: str, day_key: bool = False, as_ranges: bool = False):
    """Literal predicate on the document columns that covers every request, however many there are.

    Applied before the join it reaches the Parquet scan (``PushedFilters``,
    partition filters), so row groups and partitions outside all requests are
    never read.  It is a superset filter; the join decides membership.  ``day_key``:
    the documents have a stored ``day``, which bounds ``timestamp_range`` too.
    ``as_ranges`` writes a single criteria as a range: where equalities stand in a
    disjunction, Spark drops the run-time pruning of partitions by the join.
    """
    return any_of([box_predicate(b, selection, day_key, as_ranges) for b in boxes])
