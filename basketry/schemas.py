"""Table schemas, feature views and the check applied at table boundaries."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


_LONG, _DOUBLE, _STRING, _TIME, _INT = (
    T.LongType(),
    T.DoubleType(),
    T.StringType(),
    T.TimestampType(),
    T.IntegerType(),
)

EVENTS = _struct(
    ("event_id", _LONG),
    ("event_time", _TIME),
    ("event_type", _STRING),
    ("product_id", _LONG),
    ("category_id", _STRING),
    ("brand", _STRING),
    ("price", _DOUBLE),
    ("user_id", _LONG),
    ("user_session", _STRING),
)

EVENT_TYPES = ["view", "cart", "purchase"]

@dataclass(frozen=True)
class FeatureView:
    """Entity keys, features and time-to-live of one feature table."""

    name: str
    keys: tuple[str, ...]
    ttl_days: int
    features: tuple[tuple[str, T.DataType], ...] = field(default=())

    @property
    def feature_names(self) -> list[str]:
        return [name for name, _ in self.features]

    @property
    def ttl_seconds(self) -> int:
        return self.ttl_days * 86400

    def schema(self) -> T.StructType:
        return _struct(
            *((k, _LONG) for k in self.keys),
            ("event_timestamp", _TIME),
            *self.features,
            ("created_timestamp", _TIME),
        )


USER_STATS = FeatureView(
    "user_stats",
    ("user_id",),
    7,
    (
        ("user_total_events", _LONG),
        ("user_total_purchases", _LONG),
        ("user_total_views", _LONG),
        ("user_total_carts", _LONG),
        ("user_avg_price", _DOUBLE),
        ("user_purchase_frequency", _DOUBLE),
        ("user_session_count", _LONG),
        ("days_since_last_activity", _LONG),
    ),
)

PRODUCT_STATS = FeatureView(
    "product_stats",
    ("product_id",),
    7,
    (
        ("product_total_views", _LONG),
        ("product_total_purchases", _LONG),
        ("product_total_carts", _LONG),
        ("product_view_to_purchase_rate", _DOUBLE),
        ("product_avg_price", _DOUBLE),
        ("product_popularity_score", _DOUBLE),
        ("days_since_last_view", _LONG),
    ),
)

USER_PRODUCT = FeatureView(
    "user_product_interactions",
    ("user_id", "product_id"),
    30,
    (
        ("user_product_view_count", _LONG),
        ("user_product_cart_count", _LONG),
        ("user_product_purchase_count", _LONG),
        ("user_product_last_interaction_hours", _DOUBLE),
        ("user_product_preference_score", _DOUBLE),
    ),
)


class SchemaError(ValueError):
    """A table lacks columns that the next step needs."""


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema`` in its order and types; fail on missing columns."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise SchemaError(f"missing columns: {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
