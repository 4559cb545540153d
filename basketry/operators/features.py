"""Entity features: user, product and pair statistics, encodings, daily and demand tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions.fixed_values import MODEL_FEATURES
from ..schemas import EVENT_TYPES
from ..session import materialize
from .history import user_stats_asof
from .joins import attach


def count_type(event_type: str) -> Column:
    return F.count_if(F.col("event_type") == event_type)


def last_event_time(events: DataFrame) -> Column:
    """Newest event time of the whole table, as a one-row subquery."""
    return events.agg(F.max("event_time")).scalar()


# --- statistics per entity -------------------------------------------------------

def user_stats(events: DataFrame) -> DataFrame:
    """One conditional aggregate per user; sessions are counted distinct."""
    newest = last_event_time(events)
    return (
        events.groupBy("user_id")
        .agg(
            F.max("event_time").alias("event_timestamp"),
            F.count(F.lit(1)).alias("user_total_events"),
            count_type("purchase").alias("user_total_purchases"),
            count_type("view").alias("user_total_views"),
            count_type("cart").alias("user_total_carts"),
            F.avg("price").alias("user_avg_price"),
            F.count_distinct("user_session").alias("user_session_count"),
        )
        .select(
            "user_id",
            "event_timestamp",
            "user_total_events",
            "user_total_purchases",
            "user_total_views",
            "user_total_carts",
            "user_avg_price",
            X.purchase_rate("user_total_purchases", "user_total_events").alias("user_purchase_frequency"),
            "user_session_count",
            X.whole_days_between(newest, "event_timestamp").alias("days_since_last_activity"),
        )
    )


def user_event_pivot(events: DataFrame) -> DataFrame:
    """User x event type counts; the type list is fixed, so no extra pass finds it."""
    return events.groupBy("user_id").pivot("event_type", EVENT_TYPES).count().na.fill(0)


def product_stats(events: DataFrame) -> DataFrame:
    newest = last_event_time(events)
    return (
        events.groupBy("product_id")
        .agg(
            F.max("event_time").alias("event_timestamp"),
            count_type("view").alias("product_total_views"),
            count_type("purchase").alias("product_total_purchases"),
            count_type("cart").alias("product_total_carts"),
            F.coalesce(F.avg("price"), F.lit(0.0)).alias("product_avg_price"),
        )
        .select(
            "*",
            X.conversion_rate("product_total_purchases", "product_total_views").alias(
                "product_view_to_purchase_rate"
            ),
            X.popularity_score(
                "product_total_views", "product_total_carts", "product_total_purchases"
            ).alias("product_popularity_score"),
            X.whole_days_between(newest, "event_timestamp").alias("days_since_last_view"),
        )
    )


def user_product_stats(events: DataFrame) -> DataFrame:
    newest = last_event_time(events)
    return (
        events.groupBy("user_id", "product_id")
        .agg(
            F.max("event_time").alias("event_timestamp"),
            count_type("view").alias("user_product_view_count"),
            count_type("cart").alias("user_product_cart_count"),
            count_type("purchase").alias("user_product_purchase_count"),
        )
        .select(
            "*",
            X.hours_between(newest, "event_timestamp").alias("user_product_last_interaction_hours"),
            X.preference_score(
                "user_product_view_count", "user_product_cart_count", "user_product_purchase_count"
            ).alias("user_product_preference_score"),
        )
    )


def user_price_stats(events: DataFrame, weight: str | None = None) -> DataFrame:
    """Price statistics per user; ``user_event_count`` counts non-null prices only."""
    extra = [F.count(F.lit(1)).alias(weight)] if weight else []
    return (
        events.groupBy("user_id")
        .agg(
            F.coalesce(F.avg("price"), F.lit(0.0)).alias("user_price_mean"),
            F.coalesce(F.stddev_samp("price"), F.lit(0.0)).alias("user_price_std"),
            F.count("price").alias("user_event_count"),
            count_type("purchase").alias("user_purchase_count"),
            *extra,
        )
        .withColumn("user_purchase_rate", X.purchase_rate("user_purchase_count", "user_event_count"))
    )


def attach_user_stats(events: DataFrame, log: DataFrame | None = None) -> DataFrame:
    """Price statistics of the event's user; they are taken from ``log``, if it is another table."""
    stats = user_price_stats(events if log is None else log, weight="_rows")
    return attach(events, stats, "user_id", "_rows")


# --- categorical encodings ---------------------------------------------------------

def value_frequencies(events: DataFrame, column: str) -> DataFrame:
    """(value, n, freq) over the non-null values."""
    counts = (
        events.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    )
    total = events.agg(F.count(column)).scalar()
    return counts.withColumn("freq", F.col("n") / total)


def top_values(events: DataFrame, column: str, k: int = 20) -> DataFrame:
    """The k most frequent values, ties by value."""
    return (
        events.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(column))
        .limit(k)
    )


def category_counts(events: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n, freq) of all columns in one pass, values as text; written, since each column reads it."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = events.select(F.inline(cells)).where("value is not null").groupBy("column", "value")
    counts = materialize(counts.agg(F.count(F.lit(1)).alias("n")), "category-counts")
    # One row per column.
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(totals), "column").select(
        "column", "value", "n", (F.col("n") / F.col("total")).alias("freq")
    )


def _counts_of(counts: DataFrame, events: DataFrame, column: str) -> DataFrame:
    value = F.col("value").cast(events.schema[column].dataType).alias(column)
    return counts.where(F.col("column") == column).select(value, "n", "freq")


def frequency_encode(events: DataFrame, columns: list[str]) -> DataFrame:
    counts = category_counts(events, columns)
    out = events
    for c in columns:
        out = attach(out, _counts_of(counts, events, c).withColumnRenamed("freq", f"{c}_freq"), c, "n")
    return out


def popular_flags(events: DataFrame, columns: list[str], k: int = 20) -> DataFrame:
    """1 where the value is among the k most frequent (k rows are broadcast)."""
    out = events
    for c in columns:
        top = top_values(events, c, k).select(F.col(c), F.lit(1).alias("_top"))
        out = out.join(F.broadcast(top), c, "left").select(
            *out.columns, F.coalesce("_top", F.lit(0)).alias(f"{c}_is_popular")
        )
    return out


def encode_categories(events: DataFrame, columns: list[str], k: int = 20) -> DataFrame:
    """Frequency and popularity flag together: one pass for all counts, one join per column."""
    counts = category_counts(events, columns)
    out = events
    for c in columns:
        own = _counts_of(counts, events, c)
        top = own.orderBy(F.desc("n"), F.asc(c)).limit(k).select(c, F.lit(1).alias("_top"))
        lookup = own.join(F.broadcast(top), c, "left").select(
            c, "n", F.col("freq").alias(f"{c}_freq"), F.coalesce("_top", F.lit(0)).alias(f"{c}_is_popular")
        )
        out = attach(out, lookup, c, "n")
    return out.na.fill(0, [f"{c}_is_popular" for c in columns])


ENCODED = ["brand", "category_id", "product_id"]


def model_features(events: DataFrame) -> DataFrame:
    """The feature table of the purchase model, nulls as 0, with id, label and the encoded categories as they are.

    User statistics are as of the event: of the user's earlier events alone, so no row holds its own label
    or a later one.  The columns it needs are written once; counts and rows are read from there.
    """
    needed = ["event_id", "event_time", "event_type", "user_id", "price", *ENCODED]
    events = materialize(events.select(*needed), "model-events")
    with_calendar = events.select(
        "*",
        F.hour("event_time").alias("hour"),
        X.day_of_week("event_time").alias("day_of_week"),
        F.dayofmonth("event_time").alias("day_of_month"),
        X.is_weekend("event_time").alias("is_weekend"),
    )
    encoded = encode_categories(with_calendar, ENCODED)
    return user_stats_asof(encoded).select(
        "event_id",
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in MODEL_FEATURES],
        X.purchase_label().alias("target"),
        *ENCODED,
    )


# --- daily tables -------------------------------------------------------------------

def daily_snapshot(dated: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """Features of one day per key, valid from the following midnight."""
    return (
        dated.groupBy(*keys, "event_date")
        .agg(
            count_type("view").alias(f"{prefix}_views"),
            count_type("cart").alias(f"{prefix}_carts"),
            count_type("purchase").alias(f"{prefix}_purchases"),
            F.avg("price").alias(f"{prefix}_avg_price"),
        )
        .withColumn("event_timestamp", F.date_add("event_date", 1).cast("timestamp"))
        .withColumn("created_timestamp", F.col("event_timestamp"))
        .drop("event_date")
    )


def daily_product_stats(dated: DataFrame) -> DataFrame:
    """One row per (product, date) over all data."""
    return dated.groupBy("product_id", "event_date").agg(
        count_type("view").alias("total_views"),
        count_type("cart").alias("total_carts"),
        count_type("purchase").alias("total_purchases"),
        F.avg("price").alias("price_mean"),
        F.coalesce(F.stddev_samp("price"), F.lit(0.0)).alias("price_std"),
        F.count_distinct("user_id").alias("unique_users"),
    )


MOVING = {"total_views": "views_7d_avg", "total_purchases": "purchases_7d_avg", "total_carts": "carts_7d_avg"}


def moving_averages(panel: DataFrame, rows: int = 7) -> DataFrame:
    """Mean of the last rows per product; a product has one row per day."""
    last = Window.partitionBy("product_id").orderBy("event_date").rowsBetween(-(rows - 1), 0)
    return panel.select(
        "product_id", "event_date", *[F.avg(c).over(last).alias(name) for c, name in MOVING.items()]
    )


def merge_daily_moving(panel: DataFrame, moving: DataFrame) -> DataFrame:
    return panel.join(
        moving.dropDuplicates(["product_id", "event_date"]), ["product_id", "event_date"], "left"
    )


# --- demand ---------------------------------------------------------------------------

def daily_demand(dated: DataFrame) -> DataFrame:
    return (
        dated.where(F.col("event_type") == "purchase")
        .groupBy("event_date", "product_id")
        .agg(F.count(F.lit(1)).alias("demand"))
    )


def lagged_demand_dates(dated: DataFrame, target_days: int = 1) -> DataFrame:
    """(target_date, history_start, history_end) over the dates that have purchases.

    One row per calendar day, so the ordering of the dates is a tiny task.
    """
    dates = dated.where(F.col("event_type") == "purchase").select("event_date").distinct()
    in_order = Window.partitionBy(F.lit(0)).orderBy("event_date")
    return dates.select(
        F.col("event_date").alias("target_date"),
        F.lag("event_date", target_days).over(in_order).alias("history_start"),
        F.lag("event_date", 1).over(in_order).alias("history_end"),
    ).where(F.col("history_start").isNotNull())


def _calendar(dated: DataFrame) -> DataFrame:
    """(event_date, place, target, last) of every day with events, in the order of the days.

    The i-th day with purchases (from 0) has place 2 i and is target i; days
    between it and the next one have place 2 i + 1.  The window of target i over
    the last ``t`` purchase days is then the places 2 (i - t) to 2 (i - 1).
    ``last`` is the number of the last target.  One row per calendar day.
    """
    bought = F.max(F.when(F.col("event_type") == "purchase", 1).otherwise(0))
    days = dated.where(F.col("event_date").isNotNull()).groupBy("event_date").agg(bought.alias("bought"))
    all_days = Window.partitionBy(F.lit(0))
    target = F.sum("bought").over(all_days.orderBy("event_date")) - 1
    return days.select(
        "event_date",
        (2 * target + 1 - F.col("bought")).cast("int").alias("place"),
        F.when(F.col("bought") == 1, target.cast("int")).alias("target"),
        (F.sum("bought").over(all_days) - 1).cast("int").alias("last"),
    )


def trailing_product_features(dated: DataFrame, target_days: int = 1) -> DataFrame:
    """Product statistics over the history window of every target date.

    Events are reduced to one row per product and day before they are dealt to
    their products, and the windows slide over those rows in their tasks.  A user
    counts for the targets that the user's days cover: runs of covered targets
    enter the sum where they begin and leave it where they end.  What is shuffled
    therefore does not depend on the number of days in a window.
    """
    calendar = materialize(_calendar(dated), "calendar")
    placed = F.broadcast(calendar.select("event_date", "place", "last"))
    # Targets whose window holds a place.
    first = lambda place: F.greatest(F.floor((place + 3) / 2).cast("int"), F.lit(target_days))
    final = lambda place, last: F.least(F.floor(place / 2).cast("int") + target_days, last)

    daily = dated.groupBy("product_id", "event_date").agg(
        F.count(F.lit(1)).alias("events"),
        count_type("view").alias("views"),
        count_type("cart").alias("carts"),
        F.count("price").alias("n"),
        F.avg("price").alias("mean"),
        F.var_pop("price").alias("variance"),
    )
    measures = {
        "events": F.col("events"),
        "views": F.col("views"),
        "carts": F.col("carts"),
        "n": F.col("n"),
        "total": F.col("n") * F.col("mean"),
        "squares": F.col("n") * (F.col("variance") + F.col("mean") * F.col("mean")),
    }
    zero = F.lit(0).cast("long")
    rows = daily.join(placed, "event_date").select(
        "product_id", "place", F.lit(True).alias("is_day"), *[m.alias(name) for name, m in measures.items()],
        zero.alias("users"), zero.alias("sessions"),
    )

    def changes(column: str, name: str) -> DataFrame:
        """Where the number of distinct values of a product goes up and down."""
        known = dated.where(F.col(column).isNotNull()).join(placed, "event_date")
        places = F.array_sort(F.collect_set("place"))
        visits = known.groupBy("product_id", column).agg(places.alias("places"), F.max("last").alias("last"))
        last = F.col("last")

        def run(place: Column, i: Column) -> Column:
            before = F.when(i > 0, final(F.get("places", i - 1), last) + 1).otherwise(0)
            return F.struct(F.greatest(first(place), before).alias("start"), final(place, last).alias("end"))

        runs = F.filter(F.transform("places", run), lambda r: r["start"] <= r["end"])
        ends = F.flatten(
            F.transform(
                runs,
                lambda r: F.array(
                    F.struct((2 * r["start"]).alias("place"), F.lit(1).cast("long").alias(name)),
                    F.struct((2 * r["end"] + 2).alias("place"), F.lit(-1).cast("long").alias(name)),
                ),
            )
        )
        # At most two rows per product and place leave a task.
        return visits.select("product_id", F.inline(ends)).groupBy("product_id", "place").agg(F.sum(name).alias(name))

    for column, name in (("user_id", "users"), ("user_session", "sessions")):
        rows = rows.unionByName(changes(column, name).withColumn("is_day", F.lit(False)), allowMissingColumns=True)
    sums = [F.sum(m).alias(m) for m in (*measures, "users", "sessions")]
    by_place = rows.groupBy("product_id", "place").agg(F.max("is_day").alias("is_day"), *sums)

    # Each day asks for the targets that no earlier day of the product has asked for.
    own = Window.partitionBy("product_id").orderBy("place")
    last_target = calendar.agg(F.max("last")).scalar()
    earlier = F.max(F.when(F.col("is_day"), F.col("place"))).over(own.rowsBetween(Window.unboundedPreceding, -1))
    asked_for = F.when(F.col("_earlier").isNotNull(), final(F.col("_earlier"), F.col("_last"))).otherwise(-1)
    start = F.greatest(first(F.col("place")), asked_for + 1)
    asked = by_place.withColumns({"_earlier": earlier, "_last": last_target}).withColumns(
        {"_start": start, "_end": final(F.col("place"), F.col("_last"))}
    )
    figures = [*measures, "users", "sessions"]
    of_day = F.struct(F.col("place").alias("at"), F.lit(None).cast("int").alias("target"), *figures)
    nothing = [F.lit(None).cast(by_place.schema[c].dataType).alias(c) for c in figures]
    question = lambda i: F.struct((2 * i).alias("at"), i.alias("target"), *nothing)
    targets = F.when(F.col("is_day") & (F.col("_start") <= F.col("_end")), F.sequence("_start", "_end")).otherwise(
        F.array().cast("array<int>")
    )
    walked = asked.select("product_id", F.inline(F.concat(F.array(of_day), F.transform(targets, question))))

    by_order = Window.partitionBy("product_id").orderBy("at")
    trailing = by_order.rangeBetween(-2 * target_days, -2)
    upto = by_order.rangeBetween(Window.unboundedPreceding, 0)
    totals = walked.select(
        "product_id",
        "target",
        *[F.sum(m).over(trailing).alias(m) for m in measures],
        *[F.coalesce(F.sum(m).over(upto), F.lit(0)).alias(m) for m in ("users", "sessions")],
    ).where(F.col("target").isNotNull())
    mean = F.try_divide(F.col("total"), F.col("n"))
    spread = F.try_divide(F.col("squares") - F.col("n") * mean * mean, F.col("n") - 1)
    dates = calendar.where(F.col("target").isNotNull()).select("target", F.col("event_date").alias("target_date"))
    return totals.join(F.broadcast(dates), "target").select(
        "target_date",
        "product_id",
        F.col("events").alias("total_events"),
        "views",
        F.col("carts").alias("cart_adds"),
        F.col("users").alias("unique_users"),
        mean.alias("avg_price"),
        F.when(F.col("n") > 1, F.sqrt(F.greatest(spread, F.lit(0.0)))).alias("price_std"),
        F.col("sessions").alias("unique_sessions"),
    )


def demand_dataset(dated: DataFrame, target_days: int = 1) -> DataFrame:
    """Trailing features with the demand of the target date, every null as 0."""
    demand = daily_demand(dated).withColumnRenamed("event_date", "target_date")
    return (
        trailing_product_features(dated, target_days)
        .withColumn("day_of_week", F.weekday("target_date"))
        .withColumn("is_weekend", X.is_weekend_day("day_of_week"))
        .join(demand, ["target_date", "product_id"], "left")
        .na.fill(0)
    )


# --- scoring ----------------------------------------------------------------------------

def online_user_features(events: DataFrame) -> DataFrame:
    """Twelve numeric features per user for the scoring lookup."""
    newest = last_event_time(events)
    is_purchase = F.col("event_type") == "purchase"
    last_purchase = F.max(F.when(is_purchase, F.col("event_time")))
    return (
        events.groupBy("user_id")
        .agg(
            F.avg(F.when(is_purchase, F.col("price"))).alias("avg_purchase_amount"),
            last_purchase.alias("_last_purchase"),
            F.count(F.lit(1)).alias("total_events"),
            count_type("view").alias("total_views"),
            count_type("cart").alias("total_carts"),
            count_type("purchase").alias("total_purchases"),
            F.count_distinct("user_session").alias("session_count"),
            F.avg("price").alias("avg_price"),
            F.stddev_samp("price").alias("price_std"),
            F.max("price").alias("max_price"),
        )
        .select(
            "user_id",
            "avg_purchase_amount",
            X.purchase_rate("total_purchases", "total_events").alias("purchase_frequency"),
            X.whole_days_between(newest, "_last_purchase").alias("days_since_last_purchase"),
            "total_purchases",
            "total_events",
            "total_views",
            "total_carts",
            "session_count",
            "avg_price",
            F.coalesce("price_std", F.lit(0.0)).alias("price_std"),
            "max_price",
            X.conversion_rate("total_purchases", "total_carts").alias("cart_conversion"),
        )
    )


def on_demand_features(inputs: DataFrame, max_price: float | None = None) -> DataFrame:
    """Request-time features; the price is scaled by the batch maximum or a fixed one."""
    top = F.lit(max_price) if max_price is not None else inputs.agg(F.max("price")).scalar()

    def optional(name: str) -> Column:
        return F.col(name) if name in inputs.columns else F.lit(None).cast("double")

    return (
        inputs.withColumn("hour_sin", X.hour_sin("hour"))
        .withColumn("hour_cos", X.hour_cos("hour"))
        .withColumn("is_weekend", X.is_weekend_day("day_of_week"))
        .withColumn("price_normalized", F.try_divide(F.col("price"), top))
        .withColumn(
            "user_product_affinity",
            X.affinity(
                optional("user_product_view_count"),
                optional("user_total_views"),
                optional("product_total_views"),
            ),
        )
        .withColumn(
            "composite_score",
            X.composite_score(
                optional("user_purchase_frequency"),
                optional("product_view_to_purchase_rate"),
                "user_product_affinity",
                "price_normalized",
            ),
        )
    )


def standard_scale(
    df: DataFrame, columns: list[str], fitted_on: DataFrame | None = None
) -> DataFrame:
    """(x - mean) / population std of the fitting rows; a constant column becomes 0."""
    base = fitted_on if fitted_on is not None else df
    row = base.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_mean") for c in columns],
            *[F.stddev_pop(c).alias(f"{c}_std") for c in columns],
        )
    ).scalar()
    out = df.withColumn("_fit", row)
    for c in columns:
        std = F.col(f"_fit.{c}_std")
        out = out.withColumn(
            c, (F.col(c) - F.col(f"_fit.{c}_mean")) / F.when(std == 0, 1.0).otherwise(std)
        )
    return out.drop("_fit")


def class_weights(df: DataFrame, label: str = "target") -> DataFrame:
    """(label, n, balanced weight, positive weight): one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(
        F.struct(
            F.sum("n").alias("rows"),
            F.count(F.lit(1)).alias("classes"),
            F.sum(F.when(F.col(label) == 0, F.col("n"))).alias("negatives"),
            F.sum(F.when(F.col(label) == 1, F.col("n"))).alias("positives"),
        )
    ).scalar()
    return counts.withColumn("_t", totals).select(
        label,
        "n",
        (F.col("_t.rows") / (F.col("_t.classes") * F.col("n"))).alias("balanced_weight"),
        F.try_divide(F.col("_t.negatives"), F.col("_t.positives")).alias("positive_weight"),
    )
