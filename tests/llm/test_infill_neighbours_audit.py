"""Rearranged documents, projected neighbours and the filter audit against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm import filter_audit, infill, projected_neighbours
from basketry.llm.queries import OP11_SQL, OP13_SQL

from .common import CLASHING, GAP, awkward_rows, documents, prose

# --- fill in the middle ------------------------------------------------------------


def lined_rows():
    rng = random.Random(3)
    rows = [(100 + i, "".join(prose(rng, rng.randrange(6)) + "\n" for _ in range(rng.randrange(9))), "en", "a") for i in range(60)]
    rows += [(200 + i, "tail" + t[1] + "no line end é x", "en", "a") for i, t in enumerate(rows[:20])]
    rows += [(300, "a <P> b\nc", "en", "a"), (301, "\n\n\n", "en", "a"), (302, "<S", "en", "a"), (303, "x\n<P\n>\n", "en", "a")]
    return rows + awkward_rows()


def plain_infill(doc_id, text):
    """Form, parts and output by string work alone."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    if h4 % 100 < 50:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_rearranged_documents_equal_string_work(spark):
    rows = lined_rows()
    got = infill.rearrange(documents(spark, rows)).collect()
    made = sorted(
        (str(r.doc_id), r.n, r.form, str(r.prefix_chars), str(r.middle_chars), bytes(r.output).decode()) for r in got
    )
    wanted = [(i, *plain_infill(i, t)) for i, t, *_ in rows]
    assert made == sorted((str(i), n, f, str(p), str(m), o) for i, n, f, p, m, o in wanted)
    assert {r.form for r in got} == {"plain", "spm", "psm"}
    assert all(r.output_sha256 == hashlib.sha256(r.output).hexdigest() for r in got)
    for r in got:  # the descriptors alone give the output's length
        assert sum(p.length for p in r.pieces) == len(r.output)


def test_outputs_give_the_texts_back(spark):
    rows = lined_rows()
    back = infill.restore(infill.rearrange(documents(spark, rows))).collect()
    assert sorted((str(r.doc_id), bytes(r.text).decode()) for r in back) == sorted((str(i), t or "") for i, t, *_ in rows)
    digests = infill.round_trip(documents(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.restored_sha256) for r in digests) == sorted(
        (str(i), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in rows
    )


def test_shares_of_the_forms_follow_the_settings(spark):
    docs = documents(spark, [(i, "a\nb\nc\n", "en", "a") for i in range(400)])
    none = infill.rearrange(docs, infill.Settings(rearranged_percent=0)).select("form").distinct().collect()
    assert [r.form for r in none] == ["plain"]
    most = infill.rearrange(docs, infill.Settings(rearranged_percent=90, spm_percent=100))
    counts = {r.form: r["count"] for r in most.groupBy("form").count().collect()}
    assert set(counts) == {"plain", "spm"} and 10 <= counts["plain"] <= 80


def test_cutting_and_permuting_pieces():
    text = "ab\ncdé\nf".encode()
    whole = infill.Pieces.of(text)
    for a, b in itertools.combinations_with_replacement(range(len(text) + 1), 2):
        cut = whole.cut([a, b])
        assert len(cut.table) == 3 and cut.whole() == text and cut.sha256() == hashlib.sha256(text).hexdigest()
        for form in infill.ORDERS:
            assert infill.restored(infill.arranged(cut, form).whole(), form).whole() == text
    assert [infill.unit_end(text, i) for i in range(4)] == [0, 3, 8, 9]
    # A text's end and the sentinel after it are not taken for a sentinel.
    for form in infill.ORDERS:
        for tail in (b"<", b"<P", b"<<S", b"<M"):
            parts = infill.Pieces.of(tail * 3).cut([len(tail), 2 * len(tail)])
            assert infill.restored(infill.arranged(parts, form).whole(), form).whole() == tail * 3


# --- projected neighbours ------------------------------------------------------------

VECTORS = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))]
    + [T.StructField(c, T.StringType()) for c in ("grp", "size", "block", "v", "query", *CLASHING[:3])]
)


def vector_table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else list(v), *["x"] * 8) for i, v in rows], VECTORS)


def plain_nearest(rows, k=20):
    usable = [(i, np.array(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for qi, q in usable:
        if qi % 20 == 0:
            scored = sorted((-float((x * q).sum()), i) for i, x in usable if i != qi and len(x) == len(q))
            out[qi] = [(i, -s) for s, i in scored[:k]]
    return out


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("kind", ["random", "clustered", "norms"])
def test_recall_against_brute_force(spark, kind):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 32))
    if kind == "clustered":
        x = rng.normal(size=(50, 32))[rng.integers(0, 50, 4000)] + 0.1 * x
    if kind == "norms":
        x *= rng.lognormal(size=(4000, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    small = projected_neighbours.Settings(shard_bytes=1 << 17, group_shards=3, least_block=64, leaf=64)
    got = by_query(projected_neighbours.nearest(vector_table(spark, rows), F.col("vec_id") % 20 == 0, small))
    wanted = plain_nearest(rows)
    assert set(got) == set(wanted) and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in wanted.items())
    assert hits / (20 * len(wanted)) >= 0.9
    for q, found in got.items():  # scores are those of the original vectors, in order
        assert found == sorted(found, key=lambda e: (-e[1], e[0]))
        assert all(s == pytest.approx(float(x[i] @ x[q]), rel=1e-12, abs=1e-12) for i, s in found)


def test_awkward_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(90)]
    rows += [(200, None), (220, []), (240, [0.0] * 4), (260, [1.0, None, 0.0, 0.0]), (280, [float("nan")] * 4)]
    rows += [(300, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4), (320, [1.0, 2.0]), (340, [2.0, 1.0]), (341, [1.0, 2.0])]
    rows += [(360, [1.0] * 4), (360, [1.0] * 4), (361, [1.0] * 4), (362, [1.0] * 4)]
    got = by_query(projected_neighbours.nearest(vector_table(spark, rows), F.col("vec_id") % 20 == 0))
    exact = projected_neighbours.Settings(confidence=1 - 1e-9)
    sure = by_query(projected_neighbours.nearest(vector_table(spark, rows), F.col("vec_id") % 20 == 0, exact))
    wanted = plain_nearest(rows)
    assert set(got) == set(wanted) == set(sure)
    for q, w in wanted.items():
        assert [i for i, _ in sure[q]] == [i for i, _ in w], q
    assert [i for i, _ in got[320]] == [341, 340] and 360 not in {i for i, _ in got[360]}


def test_many_copies_rank_by_id(spark):
    rng = np.random.default_rng(3)
    same = rng.normal(size=8).tolist()
    rows = [(i, same if i % 3 == 0 else rng.normal(size=8).tolist()) for i in range(900)]
    got = by_query(projected_neighbours.nearest(vector_table(spark, rows), F.col("vec_id") == 60))
    assert [i for i, _ in got[60]] == [i for i in range(0, 66, 3) if i != 60][:20]


def test_huge_numbers_and_no_rows(spark):
    rows = [(i, [1e308 * (1 if i % 2 else -1), float(i), 1.0]) for i in range(40)]
    got = by_query(projected_neighbours.nearest(vector_table(spark, rows), F.col("vec_id") == 0))
    assert len(got[0]) == 20 and all(i % 2 == 0 for i, _ in got[0][:19])
    assert projected_neighbours.nearest(vector_table(spark, []), F.col("vec_id") == 0).count() == 0


def test_chi_square_limits():
    # Two degrees of freedom: 1 - exp(-x / 2).
    for share in (0.1, 0.5, 0.95, 0.999):
        assert projected_neighbours.chi_square_limit(share, 2) == pytest.approx(-2 * np.log(1 - share))
    draws = np.random.default_rng(4).chisquare(16, 200_000)
    assert (draws < projected_neighbours.chi_square_limit(0.95, 16)).mean() == pytest.approx(0.95, abs=0.005)


def test_the_walk_leaves_points_unverified():
    """Clustered points: the test holds long before all are verified."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(64, 32))[rng.integers(0, 64, 4096)] * 3 + 0.05 * rng.normal(size=(4096, 32))
    settings = projected_neighbours.Settings(leaf=64)
    index = projected_neighbours.Index(x, np.arange(4096), settings)
    row = type("Row", (), {"size": 32, "width": 8, "most": index.most, "vectors": index.vectors.tobytes()})
    for name, kind in projected_neighbours.PARTS.items():
        setattr(row, name, np.ascontiguousarray(getattr(index, name), kind).tobytes())
    opened = projected_neighbours.Opened(row, settings)
    assert index.ends[-1] == 4096 and sorted(index.ids.tolist()) == list(range(4096))
    found = projected_neighbours.answer([opened], np.arange(50), x[:50], settings)
    assert found.verified.mean() < 1024


# --- filter audit ----------------------------------------------------------------------

LABELS = "doc_id long, quality int, toxic int, fails int, part string, same string"


def audit_rows():
    rng = random.Random(11)
    rows = []
    for i in range(150):
        text = prose(rng, rng.choice((20, 99, 100, 150, 300)), rng.choice((30, 5000)))
        if rng.random() < 0.3:
            text = text.upper()
        if rng.random() < 0.2:
            text += rng.choice(" # $ % & * |".split())
        rows.append((i, text, rng.choice(("en", "de", None, "")), "a"))
    rows += [(150 + i, rows[rng.randrange(40)][1], "en", "a") for i in range(60)]
    rows += [(3, "another text of id 3", "en", "a"), rows[5], rows[5]]
    return rows + awkward_rows()


def plain_audit(rows, labels):
    def failing(doc_id, text):
        text = text or ""
        w = GAP.findall(text)
        smaller = any(j is not None and doc_id is not None and j < doc_id and (t or "") == text for j, t, *_ in rows)
        return {
            "A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search("[#$%&*|]", text)), "E": smaller,
        }

    docs = [(lang or "", failing(i, t), i) for i, t, lang, _ in rows]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        found = {}
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[1][f]]
                before = order[: step - 1]
                redundant = sum(d[1][f] and any(d[1][g] for g in before) for d in own)
                unique = sum(d[1][f] and sum(d[1].values()) == 1 for d in own)
                left = [d for d in left if not d[1][f]]
                removed_by[f] += len(gone)
                found["".join(order), step] = (
                    len(left), len(gone), redundant, unique, sum(d[2] in good for d in gone), sum(d[2] in toxic for d in gone)
                )
        for (order, step), v in found.items():
            out[part, order, step] = (*v, removed_by[order[step - 1]])
    return out


def test_audit_equals_applying_every_order(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "BLOCK", 16)
    rows = audit_rows()
    marks = [(i, i % 2, int(i % 7 == 0)) for i in range(0, 230, 3)] + [(3, 1, 1), (3, 0, 0), (None, 1, 1), (4, None, None)]
    labels = spark.createDataFrame([(*m, 1, "x", "y") for m in marks], LABELS)
    got = {
        (r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
        for r in filter_audit.audit(documents(spark, rows), labels).collect()
    }
    assert got == plain_audit(rows, marks)


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(documents(spark, []), labels).count() == 0
    one = filter_audit.audit(documents(spark, [(1, None, None, None)]), labels).collect()
    assert len(one) == 600 and {r.part for r in one} == {""}


def test_posting_lists_hold_the_failing_ids(spark):
    rows = audit_rows()
    lists = filter_audit.posting_lists(documents(spark, rows), spark.createDataFrame([], LABELS)).collect()
    short = sorted(str(r.doc_ids[p]) for r in lists for p in r.fails[0])
    assert short == sorted(str(i) for i, t, *_ in rows if len(GAP.findall(t or "")) < 100)
    assert sum(r.n_docs for r in lists) == len(rows)
    for r in lists:
        assert all(list(x) == sorted(set(x)) for x in (*r.fails, r.good, r.toxic))


def test_walks_over_sorted_lists(monkeypatch):
    rng = np.random.default_rng(6)
    for block in (1, 2, 7, 4096):
        monkeypatch.setattr(filter_audit, "BLOCK", block)
        for _ in range(40):
            lists = [np.unique(rng.integers(0, 300, rng.integers(0, 120))).astype(np.int32) for _ in range(rng.integers(0, 5))]
            assert filter_audit.union(lists).tolist() == sorted(set().union(*[x.tolist() for x in lists]))
            a = np.unique(rng.integers(0, 300, 60)).astype(np.int32)
            for b in lists:
                assert filter_audit.difference(a, b).tolist() == sorted(set(a.tolist()) - set(b.tolist()))


def test_sql_of_both_queries_is_registered():
    import __spark_entry__ as entry

    assert entry.oracle_sql()["op11_piece_table_infill"] == OP11_SQL
    assert entry.oracle_sql()["op13_filter_audit"] == OP13_SQL
