"""Rows of the pipeline's stages: repeated ids, missing ids, repeated rows and clashing column names."""

from __future__ import annotations

import random

import corpus_pipeline
from basketry.llm import mixing
from basketry.llm.support import written

from .common import prose, words

STAGES = dict(corpus_pipeline.STAGES)


def table(spark, rows, extra=""):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long" + extra)


def row(i, text, source="a"):
    return (i, text, "en", source, None if text is None else len(text))


def plain_dedup(rows):
    """Rows that stay: all pairs compared, groups joined, the smallest id of each with its text."""
    sets = []
    for _, text, *_ in rows:
        w = (text or "").translate({c: c + 32 for c in range(65, 91)})
        w = words(w)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            same = rows[i][:2] == rows[j][:2]
            if same or (sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    out = set()
    for g in set(group):
        own = [r for r, x in zip(rows, group) if x == g]
        out.add(min(own, key=lambda r: (r[0] is None, r[0] or 0))[0:2])
    return out


def test_near_dedup_keeps_different_texts_of_one_id(spark):
    rng = random.Random(1)
    a, b, c = prose(rng, 80), prose(rng, 80), prose(rng, 80)
    rows = [row(1, a), row(1, b), row(2, c)]
    out = STAGES["near_dedup"](spark, table(spark, rows), "")
    assert sorted(r["text"] for r in out.collect()) == sorted([a, b, c])


def test_near_dedup_against_all_pairs(spark):
    rng = random.Random(2)
    rows = []
    for i in range(60):
        text = prose(rng, rng.choice((0, 1, 4, 60, 120)))
        rows.append(row(rng.choice((i, i, 7, None)), text or rng.choice((None, "", " "))))
    for i, r in enumerate(rng.sample(rows, 30)):
        w = words(r[1])
        if w:
            w[rng.randrange(len(w))] = "changed"
        rows.append(row(rng.choice((100 + i, r[0], None)), " ".join(w)))
    rows += rng.sample(rows, 10)  # whole rows again
    out = [tuple(r)[:2] for r in STAGES["near_dedup"](spark, table(spark, rows), "").collect()]
    texts = {(i, t) for i, t in out}
    assert len(out) == len(texts)
    wanted = plain_dedup(rows)
    # Of near texts with one id, the same one always stays, but either may.
    assert sorted(str(i) for i, _ in texts) == sorted(str(i) for i, _ in wanted)
    assert texts <= {r[:2] for r in rows}


def test_rows_that_differ_in_other_columns_alone_keep_the_smallest(spark):
    text = prose(random.Random(3), 60)
    rows = [row(1, text, s) for s in ("c", "b", "d")]
    for order in (rows, rows[::-1]):
        out = STAGES["near_dedup"](spark, table(spark, order).repartition(3), "").collect()
        assert [r["source"] for r in out] == ["b"]


def test_columns_named_like_those_of_the_stages_come_back(spark):
    rng = random.Random(4)
    names = ["mix row", "mix copies", "Mix Copy", "dedup key", "dedup row", "own", "first", "component_id", "a.doc_id"]
    extra = "".join(f", `{n}` string" for n in names)
    rows = [(*row(i, prose(rng, 40), f"s{i % 3}"), *[f"{n} {i}" for n in names]) for i in range(40)]
    docs = table(spark, rows, extra)
    for stage in ("near_dedup", "pseudonyms", "source_mixing"):
        out = written(STAGES[stage](spark, docs, ""), "clash")
        assert out.columns == docs.columns
        for r in out.collect():
            assert [r[n] for n in names] == [f"{n} {r['doc_id']}" for n in names]


def test_mixed_rows_are_those_of_the_plan(spark):
    rng = random.Random(5)
    rows = [row(i, prose(rng, rng.randrange(1, 60)), rng.choice("abc")) for i in range(200)] + [row(3, "one two", "a"), row(None, "x", None)]
    docs = written(table(spark, rows), "mix-input")
    plan = mixing.mix(docs, whole=True).collect()
    copies = sorted((str(r["doc_id"]), r["size"]) for r in plan for _ in range(r["taken"] // r["size"] if r["size"] else 0))
    out = STAGES["source_mixing"](spark, docs, "").collect()
    assert sorted((str(r["doc_id"]), len(words(r["text"]))) for r in out) == copies
