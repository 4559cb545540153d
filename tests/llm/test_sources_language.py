"""Mixing (op5), pseudonyms (op6), languages (op10), top-k (op2) and the pipeline."""

import random
import re
import zlib
from datetime import date, timedelta
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from basketry.llm import kdtree, language, mixing, pseudonyms
from basketry.llm.queries import OP5_SQL
from basketry.llm.support import is_held_out, written

from .common import awkward_rows, documents, prose, words

SF = "/root/testdata/sf0.01"


# Mixing


def plain_targets(sizes):
    """Shares by 5, 2, 1, cut at three times the size and reshared until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        if not rest:
            return fixed
        level = (total - sum(fixed.values())) / sum(weight[s] for s in rest)
        above = [s for s in rest if level * weight[s] > 3 * sizes[s]]
        if not above:
            return fixed | {s: level * weight[s] for s in rest}
        fixed |= {s: 3 * sizes[s] for s in above}


@pytest.mark.parametrize("whole", [False, True])
def test_mix_reaches_targets(spark, whole):
    rng = random.Random(12)
    rows = awkward_rows()
    for i in range(400):
        rows.append((1000 + i, prose(rng, rng.randrange(1, 80)), "en", rng.choice(["b", "zz", "é", "Z", None, "hot", "hot"])))
    found = mixing.mix(documents(spark, rows), whole=whole).toPandas()
    assert len(found) == len(rows)
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    targets = plain_targets(sizes)
    assert sorted(found["size"]) == sorted(len(words(r[1])) for r in rows)
    assert (found["taken"] <= 3 * found["size"]).all() and (found["taken"] >= 0).all()
    by = found.groupby(["source_size", "target"])["taken"].sum()
    for source, size in sizes.items():
        if list(sizes.values()).count(size) > 1:
            continue
        taken = next(v for (s, _), v in by.items() if s == size)
        largest = max(len(words(r[1])) for r in rows if r[3] == source)
        assert abs(taken - targets[source]) <= (largest / 2 + 1 if whole else 1)
        assert any(abs(t - targets[source]) < 1e-6 for s, t in by.index if s == size)
    again = mixing.mix(documents(spark, rows[::-1]).repartition(7), whole=whole).toPandas()
    order = ["doc_id", "size", "source_size", "target", "taken"]
    assert found.sort_values(order)[order].equals(again.sort_values(order)[order].set_axis(found.sort_values(order).index))


def test_mix_empty(spark):
    assert mixing.mix(documents(spark, awkward_rows()).limit(0)).count() == 0
    assert "row_number" in OP5_SQL


def plain_flow(patterns, wanted, repeats):
    """Largest flow, then least cost, over all integer flows of a tiny network."""
    arcs = [(p, s) for p, (_, sources) in enumerate(patterns) for s in sources]
    best = None
    for amounts in product(*[range(min(patterns[p][0] * repeats, wanted[s]) + 1) for p, s in arcs]):
        out, into = [0] * len(patterns), [0] * len(wanted)
        for (p, s), x in zip(arcs, amounts):
            out[p] += x
            into[s] += x
        if any(x > w for x, w in zip(into, wanted)) or any(x > n * repeats for x, (n, _) in zip(out, patterns)):
            continue
        cost = sum(sum(max(0, min(n, x - k * n)) * k for k in range(repeats)) for x, (n, _) in zip(out, patterns))
        if best is None or (-sum(out), cost) < best:
            best = (-sum(out), cost)
    return best


def test_flow_is_largest_and_cheapest():
    rng = random.Random(2)
    for _ in range(60):
        n = rng.randint(1, 3)
        patterns = [(rng.randint(0, 2), sorted(rng.sample(range(2), rng.randint(1, 2)))) for _ in range(n)]
        wanted = [rng.randint(0, 4) for _ in range(2)]
        flows = mixing.route(patterns, wanted, 2)
        out = [sum(f.values()) for f in flows]
        for s in range(2):
            assert sum(f.get(s, 0) for f in flows) <= wanted[s]
        cost = sum(max(0, x - n) for x, (n, _) in zip(out, patterns))
        assert (-sum(out), cost) == plain_flow(patterns, wanted, 2)


def test_mix_overlapping_sources(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randrange(5, 30)), rng.choice([["a"], ["b"], ["a", "b"], ["c"], ["b", "c"]])) for i in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lists array<string>")
    found = mixing.mix(table, sources="lists").toPandas()
    total = sum(len(words(r[1])) for r in rows)
    assert (found["taken"] <= 3 * found["size"]).all()
    # Members of several sources count for each; what is wanted in all is the sum of the targets.
    assert found["taken"].sum() <= total + 3


# Pseudonyms


def pseudonymized(spark, texts, key="k"):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pseudonyms.pseudonymize(table, key).orderBy("doc_id").collect()
    return [r["text"] for r in rows]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def with_check(digits):
    return next(digits + c for c in "0123456789" if luhn(digits + c))


def test_cards_stay_valid_linked_and_different(spark):
    rng = random.Random(1)
    cards = [with_check("4" + "".join(rng.choice("0123456789") for _ in range(n))) for n in [14] * 150 + [11, 13, 17]]
    out = pseudonymized(spark, [f"x {c}, y" for c in cards] + [f"card {cards[0]}"])
    new = [re.search(r"\d+", t)[0] for t in out]
    assert all(luhn(a) and len(a) == len(b) and a[0] == b[0] and a != b for a, b in zip(new, cards))
    assert len(set(new[:-1])) == len(set(cards)) and new[-1] == new[0]
    wrong = [c[:-1] + str((int(c[-1]) + 1) % 10) for c in cards[:20]]
    assert pseudonymized(spark, wrong) == wrong
    spaced = " ".join(cards[0][i : i + 4] for i in range(0, 16, 4))
    assert pseudonymized(spark, [spaced])[0].replace(" ", "") == new[0]
    assert pseudonymized(spark, [cards[0]], key="other") != [new[0]]


def test_feistel_is_a_permutation(spark):
    for a, b in ((17, 43), (7, 7), (100, 10)):
        pairs = spark.range(a * b).selectExpr(f"id div {b} as x", f"id % {b} as y")
        mixed = pairs.selectExpr(f"{pseudonyms.feistel('x', 'y', str(a), str(b), 't', 'k')} as w").select("w.*")
        found = {(r["a"], r["b"]) for r in mixed.collect()}
        assert found == {(i, j) for i in range(a) for j in range(b)}


def test_dates_addresses_and_numbers_keep_their_form(spark):
    rng = random.Random(3)
    days = [date(1900, 1, 1) + timedelta(rng.randrange(73049)) for _ in range(100)]
    out = pseudonymized(spark, [d.isoformat() for d in days])
    assert len(set(out)) == len(set(days)) and all(1900 <= date.fromisoformat(t).year <= 2099 for t in out)
    forms = pseudonymized(spark, ["31.12.1999", "12/31/1999", "31-12-1999", "1999/12/31", "1999-12-31"])
    read = {(t[6:], t[3:5], t[:2]) for t in (forms[0], forms[2])} | {(forms[1][6:], forms[1][:2], forms[1][3:5])}
    read |= {tuple(re.split("[-/]", t)) for t in forms[3:]}
    assert len(read) == 1  # one day, one pseudonym, in every form
    ips = [".".join(str(rng.randrange(256)) for _ in range(4)) for _ in range(60)]
    new = pseudonymized(spark, ips)
    assert len(set(new)) == len(set(ips)) and all(0 <= int(x) <= 255 for t in new for x in t.split("."))
    phones = pseudonymized(spark, ["+1 (988) 555-2485", "988-555-2485", "988.555.2485"])
    assert len({re.sub(r"\D", "", t)[-10:] for t in phones}) == 1
    assert all(re.fullmatch(p, t) for p, t in zip([r"\+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}", r"[2-9]\d\d-[2-9]\d\d-\d{4}"], phones))
    ssn = pseudonymized(spark, ["123-45-6789", "665-01-0001", "667-99-9999"])
    assert all(re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", t) for t in ssn) and len(set(ssn)) == 3
    mails = pseudonymized(spark, ["a.Bc+9@mail.example.com", "see a.Bc+9@mail.example.com."])
    assert re.fullmatch(r"[a-z]\.[A-Z][a-z]\+\d@mail\.example\.com", mails[0]) and mails[0] in mails[1]
    secret = pseudonymized(spark, ['token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" x'])[0]
    assert re.fullmatch(r'token = "[0-9a-f]{40}" x', secret) and "24be64439e3e" not in secret


def test_clean_texts_are_left_alone(spark):
    texts = [None, "", "plain words", "v 1.2.3 of 2024", "300.1.1.1 1.2.3.4.5", "2023-02-29 1899-01-01 2100-01-01",
             "666-12-3456 000-11-2222 123-00-1234", "1234567812345678", "x@y a@b", "10,000.50", "token = short",
             "é" * 50_000 + " 12", "a." * 20_000 + "@", "1" * 30_000]
    assert pseudonymized(spark, texts) == texts


def test_secrets_of_letters_only_and_long_ones(spark):
    value = "correct-horse-battery-staple"
    alone, beside = pseudonymized(spark, [f"password={value}", f"Password: '{value}' of 7"])
    new = alone.removeprefix("password=")
    assert re.fullmatch("[a-z]{7}-[a-z]{5}-[a-z]{7}-[a-z]{6}", new) and new != value
    assert beside == f"Password: '{new}' of 7"  # equal values stay linked
    long = "0123456789abcdef" * 500
    for tail in ("", " end"):
        out = pseudonymized(spark, [f"token={long}{tail}"])[0]
        assert re.fullmatch(f"token=[0-9a-f]{{8000}}{tail}", out)
        assert not any(out[6 + i : 22 + i] == long[i : i + 16] for i in range(0, 8000, 16))


def test_pseudonyms_awkward_and_empty(spark):
    table = documents(spark, [*awkward_rows(), (50, "ip 1.2.3.4", "en", "a")])
    out = pseudonyms.pseudonymize(table, "k")
    assert out.columns == table.columns and out.dtypes == table.dtypes
    rows = out.collect()
    assert len(rows) == len(awkward_rows()) + 1
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in rows)
    assert pseudonyms.pseudonymize(table.limit(0), "k").count() == 0


# Languages


@pytest.fixture(scope="module")
def model(spark):
    return language.train(spark.read.parquet(f"{SF}/documents.parquet"), ~is_held_out())


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = language.label(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(is_held_out()).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.99
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_mixed_text_is_cut_into_spans(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars > 600").select("lang", "text")
    by = {r["lang"]: r["text"] for r in docs.dropDuplicates(["lang"]).collect()}
    parts = [(k, by[k].split()[:40]) for k in ("en", "de", "fr", "en")]
    text = " ".join(w for _, p in parts for w in p)
    row = language.label(documents(spark, [(1, text, None, None)]), model, spans=True).first()
    truth = [k for k, p in parts for _ in p]
    found = [s["lang"] for s in row["spans"] for _ in range(s["words"])]
    assert len(found) == len(truth) and np.mean([a == b for a, b in zip(found, truth)]) > 0.93
    assert row["lang_pred"] == "en" and row["spans"][0]["first"] == 0


def test_viterbi_with_more_than_256_languages():
    scores = np.zeros((6, 300), np.float32)
    scores[:3, 299], scores[3:, 256] = 5, 5
    (path,) = language.viterbi([scores], 0.7)
    assert path.tolist() == [299] * 3 + [256] * 3


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(0)
    for _ in range(40):
        lengths = rng.integers(0, 6, size=4)
        scores = [rng.normal(size=(n, 3)).astype(np.float32) for n in lengths]
        for s, path in zip(scores, language.viterbi(scores, 0.7)):
            value = lambda p: sum(s[i, x] for i, x in enumerate(p)) - 0.7 * sum(a != b for a, b in zip(p, p[1:]))
            best = max((value(p) for p in product(range(3), repeat=len(s))), default=0)
            assert abs(value(list(path)) - best) < 1e-4


def test_scripts_narrow_candidates(spark):
    rng = random.Random(4)
    greek, cyrillic = "αβγδεζηθ", "абвгдежз"
    make = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(30))
    rows = [(i, make(greek if i % 2 else cyrillic), "el" if i % 2 else "ru", "a") for i in range(40)]
    model = language.train(documents(spark, rows), F.lit(True))
    greek_only = [i for i, x in enumerate(language.SCRIPTS) if x == "greek"][0]
    assert model.scripts[greek_only].tolist() == [True, False]
    found = language.label(documents(spark, [(1, "αααα аааа бббб 12", None, None)]), model, spans=True).first()
    assert found["lang_pred"] == "ru"


def test_language_awkward_and_empty(spark, model):
    table = documents(spark, awkward_rows())
    rows = {r["doc_id"]: r for r in language.label(table, model).collect()}
    for i in (2, 3, 4, 9):
        assert (rows[i]["lang_pred"], rows[i]["score"]) == (language.UND, 0.0)
    assert rows[5]["lang_pred"] in model.languages
    assert language.label(table.limit(0), model).count() == 0
    none = language.train(table.limit(0), F.lit(True))
    assert {r["lang_pred"] for r in language.label(table, none).collect()} == {language.UND}
    kept = language.keep_known(table, model)
    assert kept.dtypes == table.dtypes and {r["doc_id"] for r in kept.collect()} <= {1, None, 5, 6, 7, 8}


# Top-k


def plain_top(rows, k, scale=1024):
    good = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for i, q in {(i, tuple(v)) for i, v in good if i % 5 == 0}:
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i and len(v) == len(q))
        out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k])}
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_top_k_matches_all_pairs(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=6), seed)]) for i in range(300)]
    rows += [(1000 + i, [0.5] * 6) for i in range(80)]  # ties
    rows += [(None, [1.0] * 6), (400, None), (405, []), (410, [None] * 6), (415, [float("nan")] * 6),
             (420, [float("inf")] * 6), (425, [1.0, 2.0]), (426, [2.0, 1.0]), (430, [1e12] * 3), (431, [-1e12] * 3), rows[0]]
    table = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, v string, shard string")
    settings = kdtree.Settings(k=7, shard_rows=50, leaf=8, block=20)
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    found = kdtree.top_k(table, F.col("vec_id") % 5 == 0, settings).collect()
    expected = plain_top([(i, v) for i, v in exact if i not in (430, 431)], 7)
    assert {tuple(r) for r in found if r["query_id"] != 430} == expected


def test_top_k_over_cells_groups_and_a_common_vector(spark):
    """A third of the rows is one vector: its cell is many shards, dealt to many groups."""
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(6, 5)) * 4
    rows = [(i, [float(x) for x in np.round(centres[i % 6] + rng.normal(size=5), 2)]) for i in range(400)]
    rows += [(1000 + i, [1.0, 0.5, -0.25, 2.0, 0.0]) for i in range(200)]
    table = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<double>")
    settings = kdtree.Settings(k=5, shard_rows=32, leaf=6, block=50, least_block=7, group_bytes=4000, sample_rows=120, most_cells=8)
    trees = kdtree.build_trees(kdtree.integer_vectors(table, 1024), settings)
    sizes = [len(r["ids"]) // 8 for r in trees.collect()]
    assert sum(sizes) == 600 and max(sizes) <= 64 and trees.select("grp").distinct().count() > 2
    found = kdtree.top_k(table, F.col("vec_id") % 5 == 0, settings).collect()
    assert {tuple(r) for r in found} == plain_top(rows, 5)


def test_cells_follow_the_sample():
    rng = np.random.default_rng(2)
    sample = rng.integers(-100, 100, size=(500, 3))
    cells = kdtree.Cells(sample, 16)
    assert cells.cells == 16 and np.bincount(cells.place(sample)).min() > 15
    assert kdtree.Cells(np.ones((50, 3), np.int64), 16).cells == 1
    assert (kdtree.Cells(sample[:0], 4).place(sample) == 0).all()


def test_top_k_empty(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert kdtree.top_k(table, F.col("vec_id") % 100 == 0).count() == 0


def test_boxes_are_tight_and_bounds_hold():
    rng = np.random.default_rng(5)
    points = rng.integers(-50, 50, size=(300, 4))
    tree = kdtree.Tree(points, np.arange(300), 16)
    queries = rng.integers(-50, 50, size=(20, 4))
    bounds = tree.bounds(queries)
    for node, (start, end, left, _) in enumerate(tree.links):
        if left < 0:
            own = tree.points[start:end]
            assert (own.min(axis=0) == tree.low[node]).all() and (own.max(axis=0) == tree.high[node]).all()
            assert (bounds[:, node] >= (queries @ own.T).max(axis=1)).all()


# Pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 150")
    base = docs.select("doc_id", "text", "lang", "source", "n_chars")
    first = base.orderBy("doc_id").first()
    more = [(9000, first["text"], None, "src0", 1), (9001, "12 34", "en", "src1", 5), (9002, None, None, None, None),
            (9003, "write to jane.doe@mail.example.com or 10.20.30.40 " + first["text"][:400], first["lang"], "src2", 9)]
    table = base.unionByName(spark.createDataFrame(more, base.schema))
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language_id"](spark, table, SF)
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert {9001, 9002} & ids == set() and 9000 in ids and kept.columns == table.columns
    unique = stages["near_dedup"](spark, kept, SF)
    left = {r["doc_id"] for r in unique.select("doc_id").collect()}
    assert 9000 not in left and first["doc_id"] in left and unique.columns == table.columns
    clean = stages["pseudonyms"](spark, unique, SF)
    assert clean.columns == table.columns
    assert not clean.where("text like '%jane.doe@%' or text like '%10.20.30.40%'").count()
    mixed = written(stages["source_mixing"](spark, written(clean, "test"), SF), "test")
    assert mixed.columns == table.columns
    copies = mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert copies <= 3
    rows = stages["packing"](spark, mixed, SF).toPandas()
    assert set(rows["doc_id"]) == {r["doc_id"] for r in mixed.select("doc_id").distinct().collect()}
    for _, one in rows.sort_values("offset").groupby("sequence_id"):
        assert one["offset"].tolist() == [0, *one["length"].cumsum().tolist()[:-1]] and one["length"].sum() <= 4096


def test_pipeline_empty(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_held_out_split(spark):
    rows = spark.range(50).select(F.col("id").alias("doc_id"), is_held_out("id").alias("out")).collect()
    assert all(r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
