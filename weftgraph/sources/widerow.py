"""Read documents out of a wide-row table.

The table has one row per key ``criteria_|_CODE_|_yyyyMMdd`` (possibly cut
into several physical rows, see ``fixtures.wide_rows``) and a map of cells:
hashed post id -> the document as JSON text.  A key-range scan (S1) or a list
of point keys (S5) picks the rows of each request, ``explode`` turns cells into
documents (S6) and ``from_json`` with an explicit schema parses them (S7).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.functions.expressions import ROW_KEY_SEPARATOR, day_of_millis, row_key
from weftgraph.operators.select import BINS, Box, any_of, in_day_bins
from weftgraph.plans.broadcast import DEFAULT_MAX_BROADCAST_ROWS, size_checked_broadcast
from weftgraph.sources.requests import DAY_LIST, DAY_RANGE, TIMESTAMP_RANGE, request_sides

# Fields of one stored document; criteria, platform and day come from the key.
DOCUMENT_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("source_type", T.StringType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("target_type", T.StringType()),
    T.StructField("target_name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("post_id", T.StringType()),
])
TEXTS, LONGS = ([f.name for f in DOCUMENT_SCHEMA.fields if isinstance(f.dataType, kind)] for kind in (T.StringType, T.LongType))
CORRUPT = "_corrupt_record"
# Names of the typed values of extended JSON.
TYPED_TEXTS = ["$oid", "$numberLong", "$numberInt", "$numberDouble", "$numberDecimal", "$symbol", "$uuid"]
TYPED_INTEGERS = ["$numberLong", "$numberInt"]
ERROR_CHARS = 200  # of a malformed document, in its error
# Greedy: a separator inside a criteria id stays in it.
_KEY_REGEX = r"(?s)^(.*)_\|_(.*)_\|_(.*)$"
# A 64-bit integer as extended JSON writes it; inside a JSON string its quotes would be escaped.
_EXTENDED_NUMBER = r'\{\s*"\$number(?:Long|Int)"\s*:\s*"([+-]?[0-9]+)"\s*\}'


def key_parts(wide: DataFrame) -> DataFrame:
    """Split ``row_key`` into ``criteria_id, platform, day``, from its end."""
    return wide.select("*", *[F.regexp_extract("row_key", _KEY_REGEX, i + 1).alias(c)
                              for i, c in enumerate(("criteria_id", "platform", "day"))])


def scan_rows(wide: DataFrame, normalized_requests: DataFrame, selection: str,
              request_rows: int | None = None, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
              n_requests: int | None = None) -> DataFrame:
    """The wide rows of each request, tagged with ``graph_id``.

    ``day_range`` is the scan ``[start_key, stop_key)`` of the reference, as an
    equality on criteria and platform plus the literal key range;
    ``day_list`` and ``timestamp_range`` look up one key per day; a request
    without a platform takes the day's key of every platform.
    """
    rows = key_parts(wide)
    if selection == DAY_RANGE:
        rq = normalized_requests.select(
            "graph_id", F.col("criteria_id").alias("_crit"), F.col("code").alias("_code"),
            row_key(F.col("criteria_id"), F.col("code"), F.col("start_day")).alias("_lo"),
            row_key(F.col("criteria_id"), F.col("code"), F.col("end_day")).alias("_hi"))
        rq = size_checked_broadcast(rq, n_requests, max_rows)
        cond = ((rows["criteria_id"] == rq["_crit"]) & (rows["platform"] == rq["_code"])
                & (rows["row_key"] >= rq["_lo"]) & (rows["row_key"] < rq["_hi"]))
        return rows.join(rq, cond).drop("_crit", "_code", "_lo", "_hi")
    if selection in (DAY_LIST, TIMESTAMP_RANGE):
        side, meets, n_side = request_sides(normalized_requests, selection, request_rows, n_requests, max_rows)
        rd = side.select("graph_id", F.col("criteria_id").alias("_crit"), F.col("code").alias("_code"),
                         F.col("from_ms").alias("_from"), F.col("to_ms").alias("_to"),
                         *[F.col(c).alias(f"_{c}") for _, _, c in meets])
        rows, rd = in_day_bins(rows, rd, meets, n_side, max_rows)
        same_platform = rows["platform"] == rd["_code"]
        if selection == TIMESTAMP_RANGE:
            same_platform = rd["_code"].isNull() | same_platform
        cond = (rows["criteria_id"] == rd["_crit"]) & same_platform
        for op, of_row, of_request in meets:
            cond = cond & F.expr(f"{of_row} {op} _{of_request}")
        if BINS[0] in rd.columns:
            cond = cond & (rows["_level"] == rd["_rlevel"]) & (rows["_bin"] == rd["_rbin"])
        joined = rows.join(rd, cond).drop("_crit", "_code", *[f"_{c}" for _, _, c in meets], *BINS, "_level", "_bin")
        return joined if selection == TIMESTAMP_RANGE else joined.drop("_from", "_to")
    raise ValueError(f"unknown selection {selection!r}")


def explode_cells(rows: DataFrame) -> DataFrame:
    """One row per cell, ``(…, qualifier, value)``."""
    others = [c for c in rows.columns if c != "cells"]
    return rows.select(*others, F.explode("cells").alias("qualifier", "value"))


def _once(df: DataFrame, *columns: Column) -> DataFrame:
    """Add ``columns`` through a generator of one row: a filter above stays there, so no expression is copied into it.

    Below a filter Spark repeats a column's expression at every use of it, here the JSON parser some hundred times a document.
    """
    return df.select("*", F.inline(F.array(F.struct(*columns))))


def _typed_text(value: Column) -> Column:
    """A text field of a variant document: text, a number or a truth value as text, or the text in a typed value."""
    plain = F.try_variant_get(value, "$", "string")  # of an object or a list, its JSON text
    nested = plain.rlike(r"^[{\[]") & F.to_json(value).rlike(r"^[{\[]")  # the text itself may begin so
    typed = F.coalesce(*[F.try_variant_get(value, f"$['{t}']", "string") for t in TYPED_TEXTS])
    return F.when(nested, typed).otherwise(plain)


def _typed_long(value: Column) -> Column:
    """An integer field of a variant document: plain, as a typed number, or the milliseconds of a typed date."""
    def get(path, kind):
        return F.try_variant_get(value, f"${path}", kind)

    def whole(number):
        return F.when(number == F.floor(number), number.try_cast("bigint"))

    date = get("['$date']", "string")
    return F.coalesce(
        get("", "bigint"), *[get(f"['{t}']", "string").try_cast("bigint") for t in TYPED_INTEGERS],
        whole(get("['$numberDouble']", "string").try_cast("double")),
        *[get(f"['$date']['{t}']", "string").try_cast("bigint") for t in TYPED_INTEGERS],
        F.when(date.rlike("^[+-]?[0-9]+$"), date.try_cast("bigint")).otherwise(F.unix_millis(F.try_to_timestamp(date))))


def _typed_document(parsed: DataFrame) -> DataFrame:
    """Add ``_texts`` and ``_longs``: the document's fields from the variant ``_v``, and ``_unread``: the first field that holds what it cannot.

    Fields of a type are read by one lambda over their variants: each is looked up once, and the plan stays small.
    """
    is_read = F.col("_v").isNotNull()

    def raw(names):
        return F.when(is_read, F.array(*[F.try_variant_get("_v", f"$.{name}", "variant") for name in names]))

    out = _once(parsed, raw(TEXTS).alias("_raw_texts"), raw(LONGS).alias("_raw_longs"))
    out = _once(out, F.transform("_raw_texts", _typed_text).alias("_texts"), F.transform("_raw_longs", _typed_long).alias("_longs"))

    def unread(kind, i, name):
        text = F.to_json(F.col(f"_raw_{kind}")[i])
        return F.when(is_read & F.col(f"_{kind}")[i].isNull() & text.isNotNull() & (text != "null"),
                      F.concat(F.lit(f"unreadable {name}: "), F.substring(text, 1, ERROR_CHARS)))

    faults = {name: unread(kind, i, name) for kind, names in (("texts", TEXTS), ("longs", LONGS)) for i, name in enumerate(names)}
    return _once(out, F.coalesce(*[faults[f.name] for f in DOCUMENT_SCHEMA.fields]).alias("_unread")).drop("_raw_texts", "_raw_longs")


def parse_documents(cells: DataFrame, on_bad: str = "fail") -> DataFrame:
    """JSON text -> document columns.

    ``on_bad="fail"`` stops the job on a malformed document (FAILFAST), as the
    reference's parser does; ``"drop"`` parses permissively and leaves out the
    documents that do not parse; ``"report"`` keeps them, with what is wrong in a
    column ``error`` (null for the others).

    Documents may be extended JSON: integers as ``{"$numberLong": "…"}`` are put
    in their place before parsing; documents with other typed values (``$date``,
    ``$numberDouble``, ``$oid`` …) are read as variants, value by value, and
    only these pay for it.  A value that its field cannot hold makes the document a malformed one, by the field's name.
    """
    text = F.col("value")
    cells = cells.withColumn("value", F.when(F.contains(text, F.lit('"$number')),
                                             F.regexp_replace(text, _EXTENDED_NUMBER, "$1")).otherwise(text))
    is_typed = F.coalesce(F.contains("value", F.lit('"$')), F.lit(False))
    schema = T.StructType(DOCUMENT_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType())])
    plain = F.from_json(F.when(~is_typed, F.col("value")), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # as texts: Spark's pruning of nested fields does not pass a struct through several generators
    plain = F.transform(F.array(plain), lambda p: F.array(
        F.when(p.isNotNull() & p[CORRUPT].isNull(), F.lit("")), *[p[name] for name in TEXTS], *[p[name].cast("string") for name in LONGS]))[0]
    out = _once(cells, is_typed.alias("_is_typed"), plain.alias("_plain"), F.when(is_typed, F.try_parse_json("value")).alias("_v"))
    is_typed = F.col("_is_typed")
    whole = F.when(is_typed, F.col("_v").isNotNull()).otherwise(F.col("_plain")[0].isNotNull())
    malformed = F.concat(F.lit("malformed document: "), F.substring(F.coalesce("value", F.lit("null")), 1, ERROR_CHARS))
    out = _typed_document(out)
    out = _once(out, F.when(~whole, malformed).when(is_typed, F.col("_unread")).alias("error"))
    error = F.col("error")
    if on_bad == "drop":
        out = out.where(error.isNull())
    used = ("qualifier", "value", "_is_typed", "_plain", "_v", "_texts", "_longs", "_unread", *([] if on_bad == "report" else ["error"]))
    others = [c for c in out.columns if c not in used]
    plain_of = {name: F.col("_plain")[i + 1] for i, name in enumerate(TEXTS + LONGS)}
    typed_of = {name: F.col(kind)[i] for kind, names in (("_texts", TEXTS), ("_longs", LONGS)) for i, name in enumerate(names)}

    def field(f):
        value = F.when(is_typed, typed_of[f.name]).otherwise(plain_of[f.name].cast(f.dataType))
        return F.when(error.isNotNull(), F.raise_error(error)).otherwise(value) if on_bad == "fail" else value

    return out.select(*others, *[field(f).alias(f.name) for f in DOCUMENT_SCHEMA.fields])


def _or_faulty(docs: DataFrame, condition):
    """A document that did not parse stays with every request that reads its row."""
    return condition | F.col("error").isNotNull() if "error" in docs.columns else condition


def select_from_wide_rows(wide: DataFrame, normalized_requests: DataFrame, selection: str,
                          require_target: bool = True, on_bad: str = "fail",
                          request_rows: int | None = None,
                          max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, n_requests: int | None = None) -> DataFrame:
    """S1/S5 -> S6 -> S7 -> P1: the documents of each request from the wide-row table."""
    rows = scan_rows(wide, normalized_requests, selection, request_rows, max_rows, n_requests)
    docs = parse_documents(explode_cells(rows), on_bad)
    if selection == TIMESTAMP_RANGE:
        docs = docs.where(_or_faulty(docs, F.col("timestamp").between(F.col("_from"), F.col("_to")))).drop("_from", "_to")
    if require_target:
        docs = docs.where(_or_faulty(docs, F.col("target").isNotNull()))
    return docs.drop("row_key", "chunk")


def key_range_predicate(boxes: list[Box], selection: str):
    """Literal ``row_key`` ranges covering the requests.

    ``[start_key, stop_key)`` for ``day_range`` (the reference's scan), the
    inclusive ``[start_key, end_key]`` otherwise (a superset of the day keys);
    a request without a platform covers all keys of its criteria, as a box of
    several criteria or platforms does from its first to its last criteria.  On a
    table sorted by key, Parquet min/max statistics then skip every row group
    outside the ranges.  Day keys are foldable expressions evaluated in the
    session time zone, like the keys themselves.
    """
    key = F.col("row_key")

    def covered(box):
        if box.first_key != box.last_key:
            return (key >= box.first_key) & ((key < box.last_key) | key.startswith(box.last_key))
        if None in box.codes or len(box.codes) > 1:
            return key.startswith(box.first_key)
        first, last = (row_key(F.lit(box.first), F.lit(next(iter(box.codes))), day_of_millis(F.lit(ms))) for ms in (box.lo, box.hi))
        return (key >= first) & ((key < last) if selection == DAY_RANGE else (key <= last))

    return any_of([covered(b) for b in boxes])
