"""Sliding product statistics against a plain count of every window."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from basketry.operators import features

SCHEMA = "event_date date, event_type string, product_id long, price double, user_id long, user_session string"


def plain(rows, target_days):
    days = sorted({r[0] for r in rows if r[0] and r[1] == "purchase"})
    found = {}
    for i, target in enumerate(days):
        if i < target_days:
            continue
        for product in {r[2] for r in rows}:
            own = [r for r in rows if r[0] and r[2] == product and days[i - target_days] <= r[0] <= days[i - 1]]
            if not own:
                continue
            prices = [r[3] for r in own if r[3] is not None]
            mean = sum(prices) / len(prices) if prices else None
            std = (sum((p - mean) ** 2 for p in prices) / (len(prices) - 1)) ** 0.5 if len(prices) > 1 else None
            found[target, product] = (
                len(own), sum(r[1] == "view" for r in own), sum(r[1] == "cart" for r in own),
                len({r[4] for r in own if r[4] is not None}), mean, std, len({r[5] for r in own if r[5] is not None}),
            )
    return found


@pytest.mark.parametrize("target_days", [1, 2, 5, 9, 40])
@pytest.mark.parametrize("seed", [1, 2])
def test_every_window_equals_the_plain_count(spark, seed, target_days):
    draw = random.Random(seed)
    start = dt.date(2024, 1, 1)
    # Days without purchases before, between and after those with them; gaps; rows without a date, user, product or price.
    kinds = [[draw.random() < 0.7, draw.random() < 0.6] for _ in range(30)]
    rows = []
    for _ in range(700):
        day = draw.randrange(30)
        some, bought = kinds[day]
        if not some:
            continue
        rows.append((
            start + dt.timedelta(day) if draw.random() < 0.98 else None,
            draw.choice(["view", "cart", "purchase"] if bought else ["view", "cart"]),
            draw.choice([1, 1, 1, 2, 3, None]), round(draw.random() * 9, 2) if draw.random() < 0.9 else None,
            draw.choice([1, 2, 3, 4, 5, 6, 7, None]), draw.choice(["a", "b", "c", "", None]),
        ))
    got = features.trailing_product_features(spark.createDataFrame(rows, SCHEMA), target_days).collect()
    expected = plain(rows, target_days)
    assert len(got) == len(expected)
    for r in got:
        want = expected[r["target_date"], r["product_id"]]
        own = (r["total_events"], r["views"], r["cart_adds"], r["unique_users"], r["avg_price"], r["price_std"], r["unique_sessions"])
        assert own[:4] == want[:4] and own[6] == want[6]
        for a, b in zip(own[4:6], want[4:6]):
            assert a == (pytest.approx(b, abs=1e-7) if b is not None else None)


def test_empty_table_and_table_without_purchases(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert features.trailing_product_features(none, 3).count() == 0
    viewed = spark.createDataFrame([(dt.date(2024, 1, d), "view", 1, 1.0, 1, "s") for d in range(1, 9)], SCHEMA)
    assert features.trailing_product_features(viewed, 3).count() == 0


def shuffled(df):
    """Rows written by the exchanges of a finished query."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_no_row_is_multiplied_before_an_exchange(tables):
    """The plan of a long window is that of a short one, and nothing is exploded by days."""
    short, long = (features.trailing_product_features(tables.dated_events, n) for n in (1, 28))
    assert shuffled(short) == shuffled(long)
    text = long._jdf.queryExecution().executedPlan().toString()
    walked = text.split("Exchange hashpartitioning")[0]
    # Targets are laid out after the last exchange by product.
    assert "sequence(" in walked and "sequence(" not in text[len(walked):]
