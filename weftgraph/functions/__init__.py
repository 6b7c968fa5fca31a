from weftgraph.functions.expressions import (
    ACCOUNT_TYPE,
    COMPLETED_STEP,
    DEFAULT_CAP,
    ID_PREFIX,
    MISSING_NAME,
    MISSING_TYPE,
    PLATFORM_CODES,
    ROW_KEY_SEPARATOR,
    account_id,
    day_of_millis,
    parse_millis,
    platform_code,
    row_key,
    xml_safe,
)

__all__ = [
    "ACCOUNT_TYPE", "COMPLETED_STEP", "DEFAULT_CAP", "ID_PREFIX", "MISSING_NAME", "MISSING_TYPE",
    "PLATFORM_CODES", "ROW_KEY_SEPARATOR", "account_id", "day_of_millis", "parse_millis",
    "platform_code", "row_key", "xml_safe",
]
