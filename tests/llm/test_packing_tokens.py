"""Packing (op3) and token files (op4)."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from basketry.llm import packing, token_files, tokens

from .common import awkward_rows, documents, prose

SPECIAL = [
    "", " ", " a  b\tc\n\n d ", "don't 's a 's", "<|endoftext|> a", "a.b ab., ., .a ΣΣ ab.", "ée ab́ ab",
    "ǅ ª º ﬁ", "İstanbul İ ß", "\x1c a \x85 b", "x  y", "12 3.4 5,6!", "日本語 テ 　 x",
]


@pytest.mark.parametrize("name,kind", [("word_bpe_49k.json", "word"), ("byte_bpe_50k.json", "byte")])
def test_pieces_give_the_ids_of_whole_texts(name, kind):
    rng = random.Random(2)
    letters = ["a", "be", " ", "  ", ".", ",", "\n", "'s", "é", "1", "́", " ", "Z"]
    texts = SPECIAL + ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(400)]
    plain = Tokenizer.from_file(tokens.default_path(name))
    own = tokens.Encoder(tokens.default_path(name), kind)
    for part in (texts, texts):  # the second time from the cache
        for text, ids in zip(part, own.encode(part, 7)):
            assert ids.tolist() == [*plain.encode(text, add_special_tokens=False).ids, 7], repr(text)


@pytest.mark.parametrize("name,kind", [("word_bpe_49k.json", "word"), ("byte_bpe_50k.json", "byte")])
def test_cuts_beside_unusual_characters(name, kind):
    """Texts are cut many at a time: borders of texts, of characters and of white space are no place to go wrong."""
    rng = random.Random(8)
    letters = [*"aZß×÷éÀ¡«»°", "\xa0", "\x85", "\x1c", "\u2003", "\u2028", "\u2014", "\u201d", "\u3000", "\u200b", "日", "😀", "́"]
    letters += [" "] * 14 + ["\n"] * 6 + ["\t", "\r\n", "'", "'s", "'ll", "###", ".", ",", "1", "²", "Ⅷ", "ab", "Über"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(25))) for _ in range(3000)]
    plain = Tokenizer.from_file(tokens.default_path(name))
    own = tokens.Encoder(tokens.default_path(name), kind)
    for text, ids in zip(texts, own.encode(texts, 7)):
        assert ids.tolist() == [*plain.encode(text, add_special_tokens=False).ids, 7], repr(text)


def test_small_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 40)
    rng = random.Random(3)
    plain = Tokenizer.from_file(tokens.default_path("byte_bpe_50k.json"))
    own = tokens.Encoder(tokens.default_path("byte_bpe_50k.json"), "byte")
    for _ in range(30):
        texts = [" ".join(rng.choice("abé") * rng.randrange(1, 5) + rng.choice(["", ".", "x"]) for _ in range(30)) for _ in range(5)]
        for text, ids in zip(texts, own.encode(texts, 0)):
            assert ids.tolist() == [*plain.encode(text, add_special_tokens=False).ids, 0]


def test_best_fit_against_exhaustive_best():
    rng = random.Random(4)
    for _ in range(60):
        capacity = packing.Capacity(tokens=10)
        sizes = [rng.randint(1, 10) for _ in range(7)]
        items = np.array([(s, 1, s * s) for s in sizes], float)
        bins, offsets = packing.best_fit(items, capacity)
        check_bins(items, bins, offsets, capacity)
        assert len(set(bins)) <= exhaustive(sizes, 10) + 1


def exhaustive(sizes, room):
    best = [len(sizes)]

    def place(i, left):
        if len(left) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(left)
            return
        for b in range(len(left)):
            if left[b] >= sizes[i]:
                left[b] -= sizes[i]
                place(i + 1, left)
                left[b] += sizes[i]
        place(i + 1, [*left, room - sizes[i]])

    place(0, [])
    return best[0]


def test_all_three_dimensions_choose_the_sequence():
    """Equally full in tokens, a sequence with less attention left is taken."""
    rng = np.random.default_rng(12)
    sizes = rng.integers(1, 4097, size=400)
    items = np.stack([sizes, np.ones(400), sizes.astype(float) ** 2], axis=1).astype(float)
    vector, plain = packing.Capacity(), packing.Capacity(weights=(1.0, 0.0, 0.0))
    a, b = packing.best_fit(items, vector)[0], packing.best_fit(items, plain)[0]
    assert all(w > 0 for w in vector.weights) and a.tolist() != b.tolist()
    assert len(set(a)) <= len(set(b)) + 1


def check_bins(items, bins, offsets, capacity):
    for b in set(bins):
        own = np.flatnonzero(bins == b)
        assert (items[own].sum(axis=0) <= capacity.vector() + 1e-9).all()
        own = own[np.argsort(offsets[own])]
        assert offsets[own].tolist() == [0, *np.cumsum(items[own, 0])[:-1]]


@pytest.mark.parametrize("score", ["residual", "dot"])
def test_every_capacity_holds(score):
    rng = np.random.default_rng(3)
    capacity = packing.Capacity(tokens=100, documents=4, attention=3000, weights=(1.0, 0.3, 0.5), score=score)
    sizes = rng.integers(1, 54, size=500)
    items = np.stack([sizes, np.ones(500), sizes**2], axis=1).astype(float)
    bins, offsets = packing.best_fit(items, capacity)
    check_bins(items, bins, offsets, capacity)
    least = max(np.ceil((items / capacity.vector()).sum(axis=0)))
    assert least <= len(set(bins)) <= 1.2 * least


def test_pack_is_gapless_and_near_the_bound(spark):
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.choice([3, 40, 200, 900])), "en", "a") for i in range(300)] + awkward_rows()
    capacity = packing.Capacity(tokens=1024)
    found = packing.pack(packing.token_pieces(documents(spark, rows), capacity=capacity), capacity, shard_rows=40).toPandas()
    total = 0
    for _, one in found.sort_values("offset").groupby("sequence_id"):
        assert one["offset"].tolist() == [0, *one["length"].cumsum().tolist()[:-1]]
        assert one["length"].sum() <= 1024
        total += 1
    assert total <= np.ceil(found["length"].sum() / 1024) * 1.05 + 1
    # Pieces: every token of every row once.
    plain = Tokenizer.from_file(tokens.default_path("word_bpe_49k.json"))
    expected = []
    for doc_id, text, *_ in rows:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        for n, start in enumerate(range(0, len(ids), 1024)):
            part = np.array(ids[start : start + 1024], "<u4")
            expected.append((-1 if doc_id is None else doc_id, n, start, len(part), zlib.crc32(part.tobytes())))
    found["doc_id"] = found["doc_id"].fillna(-1).astype(int)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(expected) == sorted(found[columns].itertuples(index=False, name=None))


def test_pack_empty(spark):
    assert packing.pack_documents(documents(spark, awkward_rows()).limit(0)).count() == 0


def test_elias_fano_round_trip():
    rng = np.random.default_rng(6)
    for n in (1, 2, 63, 64, 65, 500):
        for top in (1, 3, 1000, 100_000):
            bounds = np.concatenate([[0], np.cumsum(rng.integers(1, top + 1, size=n))])
            read = token_files.Boundaries(*token_files.encode_boundaries(bounds))
            assert [read.range(i) for i in range(n)] == list(zip(bounds.tolist(), bounds[1:].tolist()))
            assert [read.select(i) for i in range(n + 1)] == bounds.tolist()
    _, low, high, _ = token_files.encode_boundaries(np.arange(0, 300_000, 300))
    assert 8 * (len(low) + len(high)) < 1000 * (2 + 9) + 16  # n * (2 + ceil(log2(u / n))) bits


def test_files_round_trip(spark, tmp_path):
    rows = awkward_rows()
    table = documents(spark, rows).repartition(5)
    path = str(tmp_path / "files")
    token_files.write_token_files(table, path, block_ids=200)
    found = token_files.read_token_files(spark, path, with_ids=True).toPandas()
    plain = Tokenizer.from_file(tokens.default_path("byte_bpe_50k.json"))
    ordered = sorted(rows, key=lambda r: -1 if r[0] is None else r[0])
    found = found.sort_values("start")
    assert [None if np.isnan(x) else x for x in found["doc_id"].astype(float)] == [r[0] for r in ordered]
    start = 0
    ids_of = lambda t: [*plain.encode(t or "", add_special_tokens=False).ids, 0]
    for row in found.itertuples():
        ids = np.array(row.ids, "<u4")
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert sorted(list(x) for x in found["ids"]) == sorted(ids_of(r[1]) for r in rows)


def test_single_documents_are_read_through_select(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randrange(60)), "en", "a") for i in range(400)] + [(None, "no id", "en", "a"), (7, "again", "en", "a")]
    path = str(tmp_path / "some")
    token_files.write_token_files(documents(spark, rows), path, block_ids=3000)
    every = {tuple(r) for r in token_files.read_token_files(spark, path).collect()}
    some = [tuple(r) for r in token_files.read_token_files(spark, path, doc_ids=[3, 7, 399, 12345]).collect()]
    assert sorted(r[0] for r in some) == [3, 7, 7, 399] and set(some) <= every


def test_files_empty(spark, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_token_files(documents(spark, awkward_rows()).limit(0), path)
    assert token_files.read_token_files(spark, path).count() == 0
