"""Mixing sources to target weights by min-cost flow over membership patterns.

A document's size is its number of words.  Documents that belong to the same
set of sources form one pattern; a pattern offers its total size once for each
repetition, the k-th at cost k - 1.  Flow from patterns to the sources' quotas
that is largest, and among those cheapest, says how many words each pattern
gives.  Patterns and sources that are linked are solved together, each linked
group in a task of its own; a group has a row for each pattern, never for each
document.  Costs lie on the supply arcs alone and are convex, so the cheapest
flow is reached by opening the repetitions one after another and augmenting.

Inside a pattern every document is taken ``words // size of the pattern``
times, and the rest comes from documents in the order of a seeded hash, the
last of them in part (or, with ``whole``, in whole if at least half of it is
wanted).  The running total over that order is cut by hash prefix, so a source
with a third of all rows is spread over many tasks.

Defined results: a null source is a source of its own, last in order; null and
empty texts have size 0 and give nothing; repeated rows count once each; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import deque

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import components
from .support import clash_free, prepare, written

CYCLE = (5, 2, 1)
#: Rows that share a hash prefix, about; and the longest prefix in hex digits, which bounds a pattern's running total.
SHARE, LONGEST = 1_000, 5


def n_words(text: Column) -> Column:
    """Number of words; null texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def cycle_weights(sources: DataFrame, cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """Weights by place in code point order, null last; one row for each source."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in cycle]), (place % len(cycle) + 1).cast("int"))
    return sources.withColumn("weight", weight)


def quotas(sources: DataFrame, total: int, most: int) -> DataFrame:
    """``target`` of each source (source, source_size, weight): shares of ``total`` by weight.

    No target exceeds ``most`` times its source's size; what that cuts off is
    shared among the others by weight, until none is above.  Only two sums a
    round reach the driver.
    """
    cap = F.col("source_size") * most
    level = None
    while True:
        above = F.lit(False) if level is None else F.lit(level) * F.col("weight") > cap
        rest = sources.agg(
            F.sum(F.when(above, cap).otherwise(0)).alias("capped"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weights"),
        ).first()
        new = (total - (rest["capped"] or 0)) / rest["weights"] if rest["weights"] else None
        if new is None or new == level:
            break
        level = new
    if level is None:
        return sources.withColumn("target", cap.cast("double"))
    return sources.withColumn("target", F.least(F.lit(level) * F.col("weight"), cap.cast("double")))


def route(patterns: list[tuple[int, list[int]]], wanted: list[int], repeats: int) -> list[dict[int, int]]:
    """Words from each pattern (size, sources) to each source: the largest flow at the least cost."""
    flow: list[dict[int, int]] = [{s: 0 for s in sources} for _, sources in patterns]
    users: list[list[int]] = [[] for _ in wanted]
    for p, (_, sources) in enumerate(patterns):
        for s in sources:
            users[s].append(p)
    missing = list(wanted)
    for _ in range(repeats):  # the k-th repetition of every pattern, at cost k - 1
        for p, (size, _) in enumerate(patterns):
            supply = size
            while supply:
                came: dict[tuple[str, int], tuple[str, int] | None] = {("p", p): None}
                queue, end = deque([("p", p)]), None
                while queue and end is None:
                    kind, x = queue.popleft()
                    if kind == "p":
                        steps = [("s", s) for s in flow[x]]
                    else:
                        steps = [("p", q) for q in users[x] if flow[q][x] > 0]  # take back from another pattern
                    for step in steps:
                        if step not in came:
                            came[step] = (kind, x)
                            queue.append(step)
                            if step[0] == "s" and missing[step[1]] > 0:
                                end = step
                                break
                if end is None:
                    break
                path = [end]
                while came[path[-1]] is not None:
                    path.append(came[path[-1]])
                path.reverse()
                amount = min(supply, missing[end[1]])
                for a, b in zip(path, path[1:]):
                    if a[0] == "s":
                        amount = min(amount, flow[b[1]][a[1]])
                for a, b in zip(path, path[1:]):
                    if a[0] == "p":
                        flow[a[1]][b[1]] += amount
                    else:
                        flow[b[1]][a[1]] -= amount
                missing[end[1]] -= amount
                supply -= amount
    return flow


def routed(patterns: DataFrame, targets: DataFrame, repeats: int) -> DataFrame:
    """``pattern``, ``words`` from patterns (pattern, sources, size) and targets (source key, target)."""
    member = patterns.select("pattern", F.explode("sources").alias("key"))
    links = member.select(
        F.xxhash64(F.lit("pattern"), "pattern").alias("src"), F.xxhash64(F.lit("source"), "key").alias("dst")
    )
    groups = components(links)
    supply = patterns.join(groups, F.xxhash64(F.lit("pattern"), "pattern") == F.col("node")).select(
        "component", "pattern", "sources", "size", F.lit(None).cast("long").alias("wanted")
    )
    demand = targets.join(groups, F.xxhash64(F.lit("source"), "key") == F.col("node")).select(
        "component",
        F.lit(None).cast("string").alias("pattern"),
        F.array("key").alias("sources"),
        F.lit(None).cast("long").alias("size"),
        F.floor("target").cast("long").alias("wanted"),
    )

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        ends = group[group["pattern"].isna()].sort_values("sources", key=lambda c: c.map(lambda x: x[0]))
        place = {s[0]: i for i, s in enumerate(ends["sources"])}
        own = group[group["pattern"].notna()].sort_values("pattern")
        given = [(int(n), sorted(place[s] for s in set(names))) for n, names in zip(own["size"], own["sources"])]
        flows = route(given, [int(x) for x in ends["wanted"]], repeats)
        return pd.DataFrame({"pattern": own["pattern"], "words": [sum(f.values()) for f in flows]})

    return supply.unionByName(demand).groupBy("component").applyInPandas(solve, "pattern string, words long")


def source_key(source: Column) -> Column:
    """A source's name as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("null"))


def mix(
    docs: DataFrame,
    *,
    repeats: int = 3,
    cycle: tuple[int, ...] = CYCLE,
    seed: int = 17,
    whole: bool = False,
    sources: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (and the columns of ``keep``).

    ``sources`` may name an array column for documents that belong to several
    sources; then ``source_size`` and ``target`` are sums over them.  The mix is
    as large as all documents together.
    """
    prepare(docs.sparkSession)
    names = F.array(F.col("source")) if sources is None else F.col(f"`{sources}`")
    wanted = dict.fromkeys(["doc_id", "text", *(["source"] if sources is None else [sources]), *keep])
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5("text")))
    sized = written(
        clash_free(docs, wanted)
        .withColumn("names", F.array_sort(F.transform(F.array_distinct(names), source_key)))
        .select(
            F.struct("doc_id", *keep).alias("row"),
            n_words(F.col("text")).alias("size"),
            "names",
            F.to_json("names").alias("pattern"),
            order.alias("place"),
        ),
        "sized",
    )
    totals = sized.select(F.explode("names").alias("key"), "size").groupBy("key").agg(F.sum("size").alias("source_size"))
    listed = totals.withColumn("source", F.when(F.col("key") != "null", F.expr("substr(key, 2)")))
    total = sized.agg(F.sum("size")).first()[0] or 0
    targets = written(quotas(written(cycle_weights(listed, cycle), "weights"), total, repeats), "targets")
    patterns = sized.groupBy("pattern").agg(F.first("names").alias("sources"), F.sum("size").alias("size"))
    given = routed(patterns, targets.select("key", "target"), repeats)
    facts = (
        patterns.select("pattern", F.col("size").alias("pattern_size"), F.explode("sources").alias("key"))
        .join(targets, "key")
        .groupBy("pattern", "pattern_size")
        .agg(F.sum("source_size").alias("source_size"), F.sum("target").alias("target"))
        .join(given, "pattern")
        .withColumn("base", F.expr("if(pattern_size = 0, 0, words div pattern_size)"))
        .withColumn("rest", F.expr("words - base * pattern_size"))
    )
    facts = written(facts, "patterns")

    digits = 1
    rows = sized.count()
    while digits < LONGEST and 16**digits * SHARE < rows:
        digits += 1
    cut = sized.withColumn("cut", F.substring("place", 1, digits))
    starts = cut.groupBy("pattern", "cut").agg(F.sum("size").alias("size")).select(
        "pattern",
        "cut",
        F.coalesce(
            F.sum("size").over(
                Window.partitionBy("pattern").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("start"),
    )
    inside = Window.partitionBy("pattern", "cut").orderBy("place", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        cut.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, ["pattern", "cut"])
        .join(facts, "pattern")
        .withColumn("left", F.col("rest") - F.col("start") - F.col("inside"))
    )
    size = F.col("size")
    part = F.greatest(F.lit(0), F.least(F.col("left"), size))
    if whole:
        part = F.when(F.col("left") * 2 >= size, size).otherwise(0)
    return placed.select(
        "row.*", "size", "source_size", "target", (size * F.col("base") + part).cast("long").alias("taken")
    )
