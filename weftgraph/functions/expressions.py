"""Column expressions shared by the operators.

Everything here is a built-in Catalyst expression, so it stays inside
whole-stage code generation; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for the same results.
# Platform names in a request and the code used in the wide-row key.
PLATFORM_CODES = {"twitter": "TW", "facebook": "FB", "instagram": "IG"}
# Separator between criteria id, platform code and day in a wide-row key.
ROW_KEY_SEPARATOR = "_|_"
# Endpoint type that marks an account, and the prefix removed from its id.
ACCOUNT_TYPE = "TW_Account"
ID_PREFIX = "TW_"
# Attribute of an endpoint that is not in the vertex table.
MISSING_NAME = "name"
MISSING_TYPE = "Missing"
# Step written into the completion record of a request.
COMPLETED_STEP = "analysis_network"
# Default node cap of one network.
DEFAULT_CAP = 15000
# Day format of the wide-row key.
DAY_FORMAT = "yyyyMMdd"

# Account ids are decimal integers, signed or not, zero-padded or not; the cast decides whether they fit a 64-bit long.
_ID_PATTERN = r"^[+-]?[0-9]+$"


def platform_code(platform: Column, strict: bool = True) -> Column:
    """S3: request platform name -> code; unknown names fail (strict) or give null."""
    expr = None
    for name, code in PLATFORM_CODES.items():
        cond = platform == F.lit(name)
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    if strict:
        return expr.otherwise(F.raise_error(F.concat(F.lit("unknown platform: "), F.coalesce(platform, F.lit("null")))))
    return expr.otherwise(F.lit(None).cast("string"))


def day_of_millis(millis: Column) -> Column:
    """Epoch milliseconds -> ``yyyyMMdd`` in the session time zone (pinned to UTC)."""
    return F.date_format(F.timestamp_millis(millis), DAY_FORMAT)


def row_key(criteria_id: Column, code: Column, day: Column) -> Column:
    """Wide-row key ``criteria_|_CODE_|_yyyyMMdd``."""
    return F.concat_ws(ROW_KEY_SEPARATOR, criteria_id, code, day)


def parse_millis(text: Column, on_bad: str = "fail") -> Column:
    """E2 for request bounds: decimal text -> bigint; bad text fails or gives null."""
    ok = text.rlike(r"^[+-]?[0-9]+$")
    value = F.when(ok, text.try_cast("bigint"))
    if on_bad == "fail":
        return F.when(value.isNotNull(), value).otherwise(
            F.raise_error(F.concat(F.lit("bad epoch milliseconds: "), F.coalesce(text, F.lit("null")))))
    return value


def account_id(raw: Column, prefix: str = ID_PREFIX, on_bad: str = "fail") -> Column:
    """E1 + E2: remove every ``prefix`` and read the rest as a long.

    ``on_bad="fail"`` stops the job on text that is not a 64-bit integer, as
    the reference's ``toLong`` does; ``"drop"`` and ``"report"`` give null: the
    caller then treats the endpoint as absent, or puts ``bad_account_id`` in the row.
    """
    stripped = F.replace(raw, F.lit(prefix), F.lit(""))
    value = F.when(stripped.rlike(_ID_PATTERN), stripped.try_cast("bigint"))
    if on_bad == "fail":
        return F.when(value.isNotNull(), value).otherwise(F.raise_error(bad_account_id(raw)))
    return value


def bad_account_id(raw: Column) -> Column:
    """What is said of an account id that cannot be read."""
    return F.concat(F.lit("bad account id: "), F.coalesce(raw, F.lit("null")))


def xml_safe(text: Column) -> Column:
    """Remove characters XML 1.0 cannot carry (``to_xml`` fails the task on them)."""
    return F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F\uFFFE\uFFFF]", "")
