"""Column expressions: calendar parts, scores, rates, labels, stable hashing.

Everything here is a Column -> Column function, so it stays in generated code.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- calendar -------------------------------------------------------------

def day_of_week(ts) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(_col(ts))


def is_weekend(ts) -> Column:
    return (F.weekday(_col(ts)) >= 5).cast("int")


def is_weekend_day(dow) -> Column:
    return F.when(_col(dow).isin(5, 6), 1).otherwise(0)


def hour_sin(hour) -> Column:
    return F.sin(F.lit(2 * math.pi) * _col(hour) / 24)


def hour_cos(hour) -> Column:
    return F.cos(F.lit(2 * math.pi) * _col(hour) / 24)


def seconds_between(later, earlier) -> Column:
    """Exact elapsed seconds as a double (microsecond resolution)."""
    return (F.unix_micros(_col(later)) - F.unix_micros(_col(earlier))) / F.lit(1e6)


def whole_days_between(later, earlier) -> Column:
    """Completed 24-hour periods, not midnights crossed."""
    micros = F.unix_micros(_col(later)) - F.unix_micros(_col(earlier))
    return F.floor(micros / F.lit(86400e6)).cast("long")


def hours_between(later, earlier) -> Column:
    return seconds_between(later, earlier) / 3600


# --- rates and scores -----------------------------------------------------

def conversion_rate(purchases, views) -> Column:
    """Purchases per view; zero views count as one."""
    v = _col(views)
    return _col(purchases) / F.when(v == 0, 1).otherwise(v)


def purchase_rate(purchases, events) -> Column:
    return F.coalesce(F.try_divide(_col(purchases), _col(events)), F.lit(0.0))


def popularity_score(views, carts, purchases) -> Column:
    return 0.5 * _col(views) + 0.3 * _col(carts) + 0.2 * _col(purchases)


def preference_score(views, carts, purchases) -> Column:
    return 0.1 * _col(views) + 0.3 * _col(carts) + 0.6 * _col(purchases)


def affinity(pair_views, user_views, product_views) -> Column:
    pair = F.coalesce(_col(pair_views), F.lit(0))
    user = F.coalesce(_col(user_views), F.lit(1))
    product = F.coalesce(_col(product_views), F.lit(1))
    return pair / F.sqrt(user.cast("double") * product + 1)


def composite_score(frequency, conversion, affinity_score, price_share) -> Column:
    return (
        0.3 * F.coalesce(_col(frequency), F.lit(0.0))
        + 0.3 * F.coalesce(_col(conversion), F.lit(0.0))
        + 0.2 * _col(affinity_score)
        + 0.2 * (1 - _col(price_share))
    )


# --- labels and comparisons -----------------------------------------------

def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def purchase_label(event_type="event_type") -> Column:
    return flag(_col(event_type) == "purchase")


def above_half(probability, threshold: float = 0.5) -> Column:
    return flag(_col(probability) > threshold)


def discrepancy_type(difference) -> Column:
    d = _col(difference)
    return F.when(d < 0.01, "minor").when(d < 0.1, "moderate").otherwise("major")


def error_category(message, status) -> Column:
    """First match wins: time-out, connection, 5xx, 4xx, other."""
    text = F.lower(F.coalesce(_col(message), F.lit("")))
    hundreds = F.floor(_col(status) / 100)
    return (
        F.when(text.contains("timeout"), "timeout")
        .when(text.contains("connection"), "connection_error")
        .when(hundreds == 5, "server_error")
        .when(hundreds == 4, "client_error")
        .otherwise("other")
    )


# --- stable hashing -------------------------------------------------------

# 31-bit arithmetic: a product of two such numbers always fits a bigint.
_MASK = 2**31 - 1
_FACTORS = (1540483477, 739982445, 1935289751)


def _stir(h: Column) -> Column:
    """Multiply and fold the high bits down, three times."""
    for shift, factor in zip((16, 15, 13), _FACTORS):
        h = h.bitwiseXOR(F.shiftright(h, shift))
        h = (h * factor).bitwiseAND(_MASK)
    return h.bitwiseXOR(F.shiftright(h, 16))


def id_bucket(identifier, buckets: int, seed: int = 42) -> Column:
    """Bucket in [0, buckets) that depends only on the id and the seed.

    A split based on it is the same however often a lost partition is
    recomputed.  Plain bigint arithmetic: no overflow, no string hashing.
    """
    x = _col(identifier).cast("long")
    low = x.bitwiseAND(_MASK)
    high = F.shiftright(x, 31).bitwiseAND(_MASK)
    start = (low + (seed * 374761393) % _MASK).bitwiseAND(_MASK)
    mixed = _stir(_stir(start).bitwiseXOR(high))
    return F.pmod(mixed, F.lit(buckets)).cast("long")
