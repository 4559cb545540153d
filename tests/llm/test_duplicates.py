"""Near-duplicates (op8) and repeated passages (op9)."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import fm_index, graph, minhash, substrings

from .common import awkward_rows, documents, prose, words


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_sets(rows, k):
    sets = {}
    for doc_id, text, *_ in rows:
        w = words(lowered(text))
        own = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
        if doc_id is not None:
            sets.setdefault(doc_id, []).append(own)
    return sets


def plain_components(rows, k, percent):
    sets = plain_sets(rows, k)
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            for x in sets[a]:
                for y in sets[b]:
                    if x and y and 100 * len(x & y) >= percent * len(x | y):
                        p, q = sorted((find(a), find(b)))
                        parent[q] = p
    return {i: find(i) for i in ids}


def near_rows(seed, base_words=60, copies=40):
    """Groups of copies with random edits, chains of edits, and short texts."""
    rng = random.Random(seed)
    rows, n = [], 0
    for size in (1, 2, 5, copies):
        base = prose(rng, base_words).split()
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = "edit" + str(rng.randrange(10**6))
            n += 1
            rows.append((n, " ".join(own), "en", "a"))
    chain = prose(rng, base_words).split()
    for i in range(12):
        chain = list(chain)
        chain[(i * 5) % len(chain)] = f"step{i}"
        n += 1
        rows.append((n, "  ".join(w.upper() if i % 2 else w for w in chain), "en", "a"))
    for text in ("a", "A", "a b", "a b c", "A b\tC", "a b c d", "b a", ""):
        n += 1
        rows.append((n, text, "en", "a"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("stars,block", [(0, 4), (1, 8), (3, 512)])
def test_components_match_all_pairs(spark, stars, block):
    rows = near_rows(stars) + awkward_rows()[4:5]
    settings = minhash.Settings(shingle=3, percent=85, stars=stars, block=block)
    found = minhash.near_duplicates(documents(spark, rows), settings).collect()
    expected = plain_components(rows, 3, 85)
    assert {r["doc_id"]: r["component_id"] for r in found} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)
    sizes = plain_sets(rows, 3)
    assert all(r["n_shingles"] in {len(s) for s in sizes[r["doc_id"]]} for r in found)


def test_near_duplicates_awkward_and_empty(spark):
    table = documents(spark, awkward_rows())
    rows = minhash.near_duplicates(table).collect()
    assert len(rows) == len(awkward_rows())
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert {r["component_id"] for r in by[6]} == {5}  # one word more than 5
    assert [r["component_id"] for r in by[1]] == [1, 1]
    assert all(r["n_shingles"] == 0 and r["kept"] for i in (2, 3, 4) for r in by[i])
    assert all(r["kept"] and r["component_id"] is None for r in by[None])
    assert minhash.near_duplicates(table.limit(0)).count() == 0


def test_signatures_estimate_and_stop_early():
    rng = np.random.default_rng(1)
    for n in (1, 4, 30, 2000):
        errors = []
        for _ in range(30):
            pool = np.unique(rng.integers(0, 2**63, size=2 * n, dtype=np.uint64))
            a, b = np.sort(pool[:n]), np.sort(pool[n // 4 : n + n // 4])
            s = minhash.super_minhash([a, np.zeros(0, np.uint64), b], 150)
            assert (s[1] == 0xFFFFFFFF).all() and (s[[0, 2]] != 0xFFFFFFFF).all()
            errors.append((s[0] == s[2]).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
        assert abs(np.mean(errors)) < 0.03
    # Each element's values lie in different slots, one for each round.
    one = minhash.super_minhash([np.array([12345], np.uint64)], 150)[0]
    assert sorted(one >> 24) == list(range(150))


def test_graph_components(spark):
    rng = random.Random(8)
    for links in (
        [(i, i + 1) for i in range(400)],
        [(0, i) for i in range(1, 300)],
        [(rng.randrange(500), rng.randrange(500)) for _ in range(400)],
        [(7, 7), (3, None)],
        [],
    ):
        table = spark.createDataFrame(links, "src long, dst long")
        found = {r["node"]: r["component"] for r in graph.components(table).collect()}
        parent = {x: x for l in links if None not in l for x in l}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in (l for l in links if None not in l):
            p, q = sorted((find(a), find(b)))
            parent[q] = p
        assert found == {x: find(x) for x in parent}


def test_backward_search_against_counting():
    rng = np.random.default_rng(2)
    for _ in range(150):
        sigma, size = int(rng.integers(1, 6)), int(rng.integers(1, 7))
        texts = [rng.integers(1, sigma + 1, size=rng.integers(0, 20)) for _ in range(rng.integers(1, 8))]
        weights = rng.integers(1, 3, size=len(texts))
        index = fm_index.FMIndex(texts, weights, 20)
        counts = Counter()
        for t, w in zip(texts, weights):
            for i in range(len(t)):
                for j in range(i + 1, len(t) + 1):
                    counts[tuple(t[i:j])] += w
        # Matching statistics of a streamed text that is not in the index.
        other = rng.integers(0, sigma + 2, size=15)
        for least in (1, 2):
            ends = np.arange(15)
            reach = index.reach(other, ends, np.zeros(15, np.int64), least)
            for e, j in zip(ends, reach):
                longest = next((i for i in range(e + 1) if counts[tuple(other[i : e + 1])] >= least), e + 1)
                assert j == longest
        starts = np.arange(15 - size + 1)
        runs = fm_index.repeated_starts(index, other, starts[:1], starts[-1:], size, 2)
        hits = {p for _, x, y in runs for a, b in zip(x, y) for p in range(a, b + 1)}
        assert hits == {p for p in starts if counts[tuple(other[p : p + size])] >= 2}


def plain_removal(rows, size):
    counts = Counter()
    for _, text, *_ in rows:
        w = words(text)
        counts.update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for doc_id, text, *_ in rows:
        w = words(text)
        covered = {j for i in range(len(w) - size + 1) if counts[tuple(w[i : i + size])] > 1 for j in range(i, i + size)}
        kept = " ".join(x for i, x in enumerate(w) if i not in covered)
        out.append((doc_id, len(w), len(covered), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def passage_rows(seed):
    rng = random.Random(seed)
    shared = prose(rng, 50)
    line = prose(rng, 12)
    rows = []
    for i in range(60):
        parts = [prose(rng, rng.randrange(60), 40 if i % 3 else 4000)]
        if i % 2:
            cut = rng.randrange(20)
            parts.append(" ".join(shared.split()[cut : cut + rng.choice([30, 34, 35, 36, 50])]))
        if i % 7 == 0:
            parts.append((line + "\n") * rng.randrange(1, 9))
        parts.append(prose(rng, rng.randrange(60)))
        rows.append((i, "  ".join(parts), "en", "a"))
    rows += [(100, rows[3][1], "en", "b"), (101, rows[3][1], "en", "b"), (102, "x " * 200, "en", "b")]
    return rows


@pytest.mark.parametrize("hot,shard_words", [(400, 250_000), (1, 50)])
def test_removal_matches_counting(spark, hot, shard_words):
    rows = passage_rows(hot) + awkward_rows()
    settings = substrings.Settings(hot=hot, shard_words=shard_words)
    found = substrings.remove_repeated(documents(spark, rows).repartition(6), settings).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found), key=str) == plain_removal(rows, 35)


def test_removal_empty_and_text(spark):
    table = documents(spark, passage_rows(3))
    assert substrings.remove_repeated(table.limit(0)).count() == 0
    rows = substrings.remove_repeated(table, with_text=True).where(F.col("n_removed") > 0).collect()
    assert rows
    for r in rows:
        assert len(words(r["kept_text"])) == r["n_words"] - r["n_removed"]
