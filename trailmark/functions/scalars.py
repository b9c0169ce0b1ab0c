"""Scalar functions of the event domain: absence rules, hashes, names, calendar keys, user agents, feature ids."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType


def blank(c: Column) -> Column:
    """Whether a string is absent: null, '' or only spaces."""
    return F.coalesce(F.trim(c), F.lit("")) == ""


def first_not_empty(*cols: Column) -> Column:
    """The first string that isn't '' or null; '' if none is."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))


def merged(left: Column, right: Column, absent) -> Column:
    """The left value where it is set, else the right one; `absent` ('' or 0) stands for not set."""
    none = F.lit(absent)
    return F.coalesce(F.nullif(left, none), F.nullif(right, none), none)


def fill(template: str, values: dict[str, str]) -> str:
    """The template with each {name} replaced; names that aren't given stay."""
    return re.sub(r"\{(\w+)\}", lambda m: str(values.get(m[1], m[0])), template)


def java_hash_code(c: Column) -> Column:
    """The 32-bit polynomial hash (base 31) of a string's UTF-16 units, as an INT; characters beyond the basic plane
    are two of them."""

    def add(acc: Column, x: Column) -> Column:
        code = F.ascii(x)
        high = F.lit(0xD800) + F.floor((code - 0x10000) / 0x400).cast("bigint")
        low = F.lit(0xDC00) + (code - 0x10000) % 0x400
        return F.when(code < 0x10000, acc * 31 + code).otherwise((acc * 31 + high) * 31 + low).bitwiseAND(F.lit(0xFFFFFFFF))

    wrapped = F.aggregate(F.regexp_extract_all(c, F.lit("(?s)(.)"), 1), F.lit(0).cast("bigint"), add)
    return F.when(wrapped >= 1 << 31, wrapped - (1 << 32)).otherwise(wrapped).cast("int")


@F.pandas_udf(LongType())
def _xxh64(text: pd.Series) -> pd.Series:
    import xxhash

    def one(x):
        n = xxhash.xxh64_intdigest(x or "", 0)
        return n - (1 << 64) if n >> 63 else n

    return text.map(one)


def xxh64(c: Column) -> Column:
    """XXH64 with seed 0 (the built-in xxhash64 has another seed); meant for columns of distinct values."""
    return _xxh64(c)


def xxh64_hex(c: Column) -> Column:
    """Its lower-case hex digits, without leading zeros."""
    return F.lower(F.hex(xxh64(c)))


def query_hash(query: Column) -> Column:
    return xxh64(F.lower(query))


#: Names of the action types by number.
ACTION_NAMES = {
    0: "UNKNOWN_ACTION_TYPE", 1: "CUSTOM_ACTION_TYPE", 2: "NAVIGATE", 3: "PURCHASE", 4: "ADD_TO_CART", 5: "SHARE",
    6: "LIKE", 7: "COMMENT", 8: "CHECKOUT", 9: "UNLIKE", 10: "REMOVE_FROM_CART", 11: "MAKE_OFFER",
    13: "ANSWER_QUESTION", 14: "COMPLETE_SIGN_IN", 15: "COMPLETE_SIGN_UP",
}


def action_name(action_type: Column, custom: Column) -> Column:
    """The type's name; a custom action's own string; the unknown name for anything else."""
    out = F.lit(ACTION_NAMES[0])
    for number, name in ACTION_NAMES.items():
        out = F.when(action_type == number, custom if number == 1 else F.lit(name)).otherwise(out)
    return out


def hour_key(ts: Column) -> Column:
    """yyyyMMddHH as a number."""
    return F.date_format(ts, "yyyyMMddHH").cast("bigint")


def floor_millis(ms: Column, step: int) -> Column:
    return F.floor(ms / step).cast("bigint") * step


#: Bits of a feature id. Type above bit 12, metric in bits 5 to 12, window in bits 0 to 4.
WINDOW_BITS = {"NONE": 0, "HOUR": 2, "DAY": 4, "DAY_7": 6, "DAY_30": 8, "DAY_90": 10}
TYPE_BITS = {
    "ITEM_DEVICE_COUNT": 0x102000, "USER_COUNT": 0x118000, "LOG_USER_COUNT": 0x12E000, "USER_ITEM_COUNT": 0x144000,
    "USER_ITEM_HOURS_AGO": 0x146000, "LOG_USER_ITEM_COUNT": 0x148000, "LOG_USER_ITEM_HOURS_AGO": 0x14A000,
    "USER_QUERY_COUNT": 0x178000, "USER_QUERY_HOURS_AGO": 0x17A000, "LOG_USER_QUERY_COUNT": 0x17C000,
    "LOG_USER_QUERY_HOURS_AGO": 0x17E000,
}
#: Numbers of our own for the two kinds of counts by query.
TYPE_BITS |= {"QUERY_COUNT": 0x180000, "ITEM_QUERY_COUNT": 0x182000}
COUNT_IMPRESSION = 1 << 5


def metric(action_type: Column) -> Column:
    """The metric bits of an action type; types without a name of their own count as unknown (0), and an impression
    without an action (null) as an impression."""
    known = action_type.isin([n for n in ACTION_NAMES if n > 1])
    bits = F.when(known, F.shiftleft(action_type, 5)).otherwise(F.lit(0))
    return F.when(action_type.isNull(), F.lit(COUNT_IMPRESSION)).otherwise(bits)


def feature_id(kind: str, metric_bits: Column, window: str) -> Column:
    return metric_bits.bitwiseOR(F.lit(TYPE_BITS[kind] | WINDOW_BITS[window]))


def feature_parts(feature: Column) -> dict[str, Column]:
    """Type, metric and window bits of a feature id."""
    return {
        "type_bits": feature.bitwiseAND(F.lit(~0x1FFF)),
        "metric_bits": feature.bitwiseAND(F.lit(0x1FE0)),
        "window_bits": feature.bitwiseAND(F.lit(0x1F)),
    }


#: Substrings that mark automated agents; a short list of our own.
BOT_PATTERN = r"bot\b|crawler|spider|slurp|curl/|wget|python-requests|headless|scrapy|monitoring"
_OS = (("Windows", "windows nt"), ("iOS", "iphone|ipad"), ("Android", "android"), ("Mac OS X", "mac os x"), ("Linux", "linux"))
_BROWSERS = (("Edge", "edg/"), ("Opera", "opr/"), ("Chrome", "chrome/"), ("Firefox", "firefox/"), ("Safari", "safari/"))


def _family(agent: Column, table) -> Column:
    out = F.lit("Other")
    for name, pattern in reversed(table):
        out = F.when(F.lower(agent).rlike(pattern), F.lit(name)).otherwise(out)
    return out


def os_family(agent: Column) -> Column:
    return _family(agent, _OS)


def browser_family(agent: Column) -> Column:
    return _family(agent, _BROWSERS)


def is_bot(agent: Column) -> Column:
    return F.lower(F.coalesce(agent, F.lit(""))).rlike(BOT_PATTERN)


def little_endian(c: Column) -> Column:
    """The eight bytes of a long, the least first."""
    pairs = F.regexp_extract_all(F.lpad(F.hex(c), 16, "0"), F.lit("(..)"), 1)
    return F.unhex(F.array_join(F.reverse(pairs), ""))


def user_key_bytes(platform_id: Column, log_user_id: Column) -> Column:
    """Message key of a user: platform as eight little-endian bytes, then the user's bytes."""
    return F.concat(little_endian(platform_id), F.encode(log_user_id, "UTF-8"))


#: Separators of the key-value store: parts of a key, and the marks of user and query keys.
PART, MARK = "\x1f", "\x1d"


def store_key(*parts: Column) -> Column:
    return F.concat_ws(PART, *[p.cast("string") for p in parts])
