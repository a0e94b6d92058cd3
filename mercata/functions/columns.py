"""Column expressions: nested access, cleaning, channel naming, exact rounding.

Everything here is built-in Spark SQL; nothing runs in Python workers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"

# Fixed value: how a missing numeric session id reads once it is made text.
MISSING_ID_TEXT = "<NA>"


# --- nested event fields -------------------------------------------------

def event_param(params: Column, key: str, variant: str = "int_value") -> Column:
    """Value of ``key`` in an array of key/value structs, NULL when absent."""
    hit = F.get(F.filter(params, lambda p: p["key"] == F.lit(key)), F.lit(0))
    return hit["value"][variant]


def items_value(items: Column) -> Column:
    """Sum of price * quantity; unpriced items are skipped, none left gives NULL."""
    def add(acc: Column, item: Column) -> Column:
        term = (item["price"] * item["quantity"]).cast("decimal(28,2)")
        return F.coalesce((acc + term).cast("decimal(28,2)"), term, acc)

    return F.aggregate(items, F.lit(None).cast("decimal(28,2)"), add)


def session_key(user: Column, ga_session_id: Column) -> Column:
    """``user_sessionid``; a missing id keeps a readable token, a missing user is NULL."""
    return F.concat(user, F.lit("_"),
                    F.coalesce(ga_session_id.cast("string"), F.lit(MISSING_ID_TEXT)))


# --- cleaning ------------------------------------------------------------

def parse_date(c: Column, fmt: str = "yyyyMMdd") -> Column:
    """Text to DATE, with or without a time part; anything that does not parse becomes NULL."""
    text = c.cast("string")
    return F.coalesce(F.try_to_date(text, fmt), F.try_to_date(text, f"{fmt} HH:mm:ss"))


def micros_to_ts(c: Column) -> Column:
    """Microseconds since 1970 to TIMESTAMP_NTZ, whatever the session time zone."""
    return F.timestamp_add("MICROSECOND", c.try_cast("bigint"),
                           F.lit(EPOCH).cast("timestamp_ntz"))


def ts_to_micros(c: Column) -> Column:
    """TIMESTAMP_NTZ to microseconds since 1970."""
    return F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), c)


def negative_to_null(c: Column) -> Column:
    return F.when(c >= 0, c)


def invalid_to_default(c: Column, default) -> Column:
    """NULL or negative becomes ``default``; zero is a valid value and stays."""
    return F.when(c.isNull() | (c < 0), F.lit(default)).otherwise(c)


def is_incomplete_purchase(event_name: Column, transaction_id: Column) -> Column:
    return F.coalesce((event_name == "purchase") & transaction_id.isNull(), F.lit(False))


# --- channels ------------------------------------------------------------

def channel_key(source: Column, medium: Column) -> Column:
    """Join key of a channel: lowered ``source / medium``, NULL if either is."""
    return F.lower(F.concat(source, F.lit(" / "), medium))


def channel_type(medium: Column) -> Column:
    """First matching class of a traffic medium."""
    # The classes, their marks and their order.
    m = F.lower(medium)
    return (F.when(m.contains("cpc") | m.contains("paid"), "paid")
            .when(m.contains("email"), "email")
            .when(m.contains("organic"), "organic")
            .when(m.contains("(none)") | m.contains("direct"), "direct")
            .when(m.contains("referral"), "referral")
            .otherwise("other"))


# --- exact arithmetic ----------------------------------------------------

def money(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def exact_sum(c: Column) -> Column:
    """Sum of per-row credits held at ten decimals, so row order cannot matter."""
    return F.sum(c.cast("decimal(28,10)"))


def safe_ratio(num: Column, den: Column, digits: int = 2) -> Column:
    """num / den rounded half up on decimals; NULL when the denominator is 0."""
    return F.round(num.cast("decimal(28,4)") / F.nullif(den.cast("decimal(18,2)"), F.lit(0)),
                   digits)


def percent(part: Column, whole: Column) -> Column:
    """Two-decimal percentage of two counts, NULL when ``whole`` is 0."""
    return F.round(part.cast("decimal(20,0)") * 100
                   / F.nullif(whole.cast("decimal(20,0)"), F.lit(0)), 2)


def plain_number(c: Column) -> Column:
    """Two-decimal amount as text without a padding zero: 38.50 reads ``38.5``."""
    return F.regexp_replace(c.cast("decimal(18,2)").cast("string"), r"(\.\d)0$", "$1")
