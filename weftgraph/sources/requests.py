"""Network requests: decoding (R1), normalisation (S3, S4) and day expansion.

A request names a criteria id, a platform, a time range in epoch milliseconds
and an output path, all as strings.  Each request becomes one network, keyed
by ``graph_id``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.functions.expressions import day_of_millis, parse_millis, platform_code, row_key

REQUEST_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("platform", T.StringType()),
    T.StructField("criteria_id", T.StringType()),
    T.StructField("from", T.StringType()),
    T.StructField("to", T.StringType()),
])

# Selection modes (R3): which bounds a request's range has.
DAY_RANGE = "day_range"              # whole days, end day excluded (wide-row key scan)
DAY_LIST = "day_list"                # whole days, end day included (one key per day)
TIMESTAMP_RANGE = "timestamp_range"  # milliseconds, both ends included (document store)
SELECTIONS = (DAY_RANGE, DAY_LIST, TIMESTAMP_RANGE)

MS_PER_DAY = 86_400_000


def requests_frame(spark: SparkSession, requests: Iterable[Mapping[str, object]]) -> DataFrame:
    """Requests given as dicts (the JSON objects of the queue) -> DataFrame.

    Built as a SQL ``VALUES`` list with bound parameters, i.e. a local relation:
    Catalyst folds the request normalisation into constants and a broadcast of
    it needs no Spark job.
    """
    requests = list(requests)
    names = [f.name for f in REQUEST_SCHEMA.fields]
    if any(r.get("graph_id") is not None for r in requests):
        names.append("graph_id")  # caller-chosen network keys
    rows, args = [], {}
    for j, r in enumerate(requests):
        marks = []
        for i, n in enumerate(names):
            args[f"r{j}c{i}"] = None if r.get(n) is None else str(r.get(n))
            marks.append(f":r{j}c{i}")
        rows.append("(" + ", ".join(marks) + ")")
    if not rows:
        return spark.createDataFrame([], REQUEST_SCHEMA)
    cols = ", ".join(f"c{i}" for i in range(len(names)))
    select = ", ".join(f"CAST(c{i} AS STRING) AS `{n}`" for i, n in enumerate(names))
    return spark.sql(f"SELECT {select} FROM VALUES {', '.join(rows)} AS t({cols})", args=args)


def decode_requests(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON text, one request per row -> request columns (all strings) and the ``raw`` text."""
    parsed = F.from_json(F.col(column), REQUEST_SCHEMA)
    return lines.select(parsed.alias("r"), F.col(column).alias("raw")).select("r.*", "raw")


def default_graph_id(criteria_id: Column, code: Column, start: Column, end: Column) -> Column:
    return F.concat_ws("_", criteria_id, F.coalesce(code, F.lit("ALL")), start, end)


def normalize_requests(requests: DataFrame, selection: str, strict: bool = True, dedupe: bool = True) -> DataFrame:
    """Add ``graph_id``, the platform ``code``, the bounds in ms and as day keys.

    In ``timestamp_range`` mode the platform is optional (the document-store
    variant never reads it): an empty or null platform selects every platform.
    Requests for the same network collapse into one row; one ``graph_id`` given
    to two different networks is an error.
    """
    if selection not in SELECTIONS:
        raise ValueError(f"selection must be one of {SELECTIONS}, got {selection!r}")
    platform = F.col("platform")
    code = platform_code(platform, strict)
    if selection == TIMESTAMP_RANGE:
        code = F.when(platform.isNull() | (platform == ""), F.lit(None).cast("string")).otherwise(code)
    on_bad = "fail" if strict else "drop"
    from_ms = parse_millis(F.col("from"), on_bad)
    to_ms = parse_millis(F.col("to"), on_bad)
    cols = requests.columns
    gid = default_graph_id(F.col("criteria_id"), F.col("code"), F.col("from"), F.col("to"))
    if "graph_id" in cols:
        gid = F.coalesce(F.col("graph_id"), gid)
    out = (requests
           .withColumn("code", code)
           .withColumn("from_ms", from_ms)
           .withColumn("to_ms", to_ms)
           .withColumn("start_day", day_of_millis(F.col("from_ms")))
           .withColumn("end_day", day_of_millis(F.col("to_ms")))
           .withColumn("graph_id", gid))
    if not dedupe:
        return out
    network = F.struct("criteria_id", "code", "from_ms", "to_ms")
    one = out.groupBy("graph_id").agg(F.min(F.struct(*out.columns)).alias("r"), F.min(network).alias("a"),
                                      F.max(network).alias("b"))
    agreed = F.when(F.col("a").eqNullSafe(F.col("b")), F.col("r")).otherwise(
        F.raise_error(F.concat(F.lit("requests for different networks share graph_id "), F.col("graph_id"))))
    return one.select(agreed.alias("r")).select("r.*")


def unique_requests(requests: Iterable[Mapping[str, object]], selection: str) -> list[dict]:
    """Driver-side de-duplication of a request list: one request per network.

    Bounds given as numbers and as text are the same bounds.  A caller-chosen
    ``graph_id`` may come again with the same network only.
    """
    seen, out = {}, []
    for r in requests:
        r = dict(r)
        platform = r.get("platform")
        if selection == TIMESTAMP_RANGE and platform == "":
            r["platform"] = platform = None
        network = tuple(None if v is None else str(v) for v in (r.get("criteria_id"), platform, r.get("from"), r.get("to")))
        key = r.get("graph_id") or network
        if key not in seen:
            seen[key] = network
            out.append(r)
        elif seen[key] != network:
            raise ValueError(f"requests for different networks share graph_id {key!r}")
    return out


def request_days(normalized: DataFrame, selection: str) -> DataFrame:
    """One row per request and selected day, with the wide-row key of that day.

    ``day_range`` stops before the end day (a scan's stop key is exclusive);
    ``day_list`` includes it; ``timestamp_range`` covers every day the range
    touches (the exact millisecond bounds are applied to the documents).
    A range whose start is after its end selects nothing.
    """
    start = F.to_date(F.col("start_day"), "yyyyMMdd")
    end = F.to_date(F.col("end_day"), "yyyyMMdd")
    if selection == DAY_RANGE:
        end = F.date_sub(end, 1)
    days = F.when(start <= end, F.sequence(start, end, F.expr("interval 1 day"))) \
        .otherwise(F.array().cast("array<date>"))
    out = normalized.select("*", F.explode(days).alias("_d")) \
        .withColumn("day", F.date_format("_d", "yyyyMMdd")).drop("_d")
    return out.withColumn("row_key", row_key(F.col("criteria_id"), F.col("code"), F.col("day")))


def request_sides(normalized: DataFrame, selection: str, request_rows: int | None, n_requests: int | None,
                  max_rows: int) -> tuple[DataFrame, list[tuple[str, str, str]], int | None]:
    """The request side of a selection by days, how its columns meet ``day`` ((operator, "day", column)), and its rows.

    While the requested days are proven few (``request_rows``), one row per
    request and day is broadcast and meets ``day`` by equality.  Beyond that
    there is one row per request with the first and last day, to be cut into bins.
    """
    if request_rows is not None and request_rows <= max_rows:
        return F.broadcast(request_days(normalized, selection)), [("=", "day", "day")], request_rows
    last = F.to_date("end_day", "yyyyMMdd")
    if selection == DAY_RANGE:
        last = F.date_sub(last, 1)
    rows = normalized.withColumn("last_day", F.date_format(last, "yyyyMMdd"))
    return rows, [(">=", "day", "start_day"), ("<=", "day", "last_day")], n_requests


def day_count(selection: str, from_ms: int, to_ms: int) -> int:
    """Days selected by one request (driver-side bound for a broadcast check)."""
    first, last = from_ms // MS_PER_DAY, to_ms // MS_PER_DAY
    if selection == DAY_RANGE:
        last -= 1
    return max(0, last - first + 1)
