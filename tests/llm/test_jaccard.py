"""The Jaccard join against a plain one: given tables, edited copies of every size, and awkward rows."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest

from gleanery.llm import jaccard

sys.path.insert(0, str(Path(__file__).resolve().parent))
import plain  # noqa: E402

SCHEMA = "doc_id long, text string, ref string, n int, id string, shingle int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in rows], SCHEMA)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def edited(n, seed):
    """Copies of texts of all sizes with up to a third of their words changed, and passages that many of them share."""
    draw = random.Random(seed)
    word = lambda: "w%d" % draw.randint(0, 5000)
    passage, rows = [word() for _ in range(60)], []
    bases = [[word() for _ in range(int(1.6 ** draw.uniform(1, 14)))] for _ in range(n // 12)]
    for i in range(n):
        words = list(bases[min(i % 17, 1) * draw.randrange(len(bases))])  # a good part of all are copies of one
        for _ in range(int(len(words) * draw.choice([0, 0.005, 0.01, 0.02, 0.03, 0.05]))):
            words[draw.randrange(len(words))] = word()
        if draw.random() < 0.3:
            words[len(words) // 2:len(words) // 2] = passage
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("chunk, bits", [(4, 8), (2048, 24)])
def test_edited_copies(spark, monkeypatch, chunk, bits):
    rows = edited(500, chunk)
    monkeypatch.setattr(jaccard.jaccard_classes, "__defaults__", (*jaccard.jaccard_classes.__defaults__[:-2], bits, chunk))
    assert found(jaccard.op11(table(spark, rows))) == plain.jaccard(rows)


def test_given(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert found(jaccard.op11(docs)) == plain.jaccard([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_awkward_rows(spark):
    long = " ".join(f"word{i % 9973} and {i}," for i in range(30_000))
    rows = [
        (0, None), (1, ""), (2, " \t\n\x0b\x0c\r"), (3, "one"), (4, "ONE"), (5, "one two three four"), (6, "one two three four five"), (6, "one two three four five"),
        (8, "One\ttwo three  four FIVE"), (None, "one two three four five"), (None, None), (9, long), (10, long.replace("word77 ", "wort ", 40)), (7, "Ünïcödé É é"), (12, "ünïcödé é é"),
        (13, "a a a a a a a a a a"), (14, "a a a a a"), (15, "a a a a"), (-3, "one two three four\xa0five"),
    ]
    assert found(jaccard.op11(table(spark, rows))) == plain.jaccard(rows)
    for none in ([], [(1, None)], [(1, "")]):
        assert found(jaccard.op11(table(spark, none))) == plain.jaccard(none)


def test_tiles_in_batches():
    """Entries cut into batches anywhere give each tile's sets with its first one, and never miss that there are more than two."""
    import pyarrow as pa

    rng = np.random.default_rng(2)
    rows = sorted({(int(s), int(r), 4 + int(r) % 9) for s, r in zip(rng.integers(-30, 30, 300), rng.integers(-9, 9, 300))} | {(99, 5, 6)})
    rows = sorted(rows + rows[::7])  # some entries come twice
    band = lambda n: int(np.floor(np.log(n) / np.log(1.25) + 1e-9))
    tiles = {}
    for s, r, n in dict.fromkeys(rows):
        for t in (band(n), band(n) + 1):
            tiles.setdefault((s, t), []).append((r, n))
    expected = sorted((*t[0], b, *x, len(t) > 2) for (s, b), t in tiles.items() for x in t[1:])
    for size in (1, 2, 3, 17, 500):
        batches = [pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows[at:at + size]], pa.int64()) for i in range(3)], ["shingle", "ref", "n"]) for at in range(0, len(rows), size)]
        got = sorted(tuple(x) for out in jaccard._stars(iter(batches), 80) for x in zip(*(c.to_pylist() for c in out.columns)))
        assert [x[:5] for x in got] == [x[:5] for x in expected]
        assert all(g[5] or not e[5] for g, e in zip(got, expected))
        if size == 500:
            assert sum(g[5] for g in got) - sum(e[5] for e in expected) <= 3


def test_bounds_hold():
    """Bitmaps of any two sizes never say more than the sets differ in, and prefixes of similar sets meet."""
    rng = np.random.default_rng(5)
    for n in (1, 3, 31, 33, 200, 900):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for keep in (0.7, 0.85, 1.0):
            b = np.unique(np.concatenate([a[rng.random(len(a)) < keep], rng.integers(0, 1 << 63, max(1, n // 4), dtype=np.uint64)]))
            overlap = len(np.intersect1d(a, b))
            assert jaccard.differing(jaccard.bitmap(a), jaccard.bitmap(b)) <= len(a) + len(b) - 2 * overlap
            if jaccard.similar(overlap, len(a), len(b)):
                assert set(a[: jaccard.prefix_length(len(a))]) & set(b[: jaccard.prefix_length(len(b))])


def test_only_sets_that_may_link_are_read_in_tiles():
    """Of a tile, sets without a possible link to another class go before their arrays are dealt out; linked pairs stay, whatever their sizes."""
    rng = np.random.default_rng(8)
    base = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (110, 120, 128, 140, 150)]
    arrays = [*base, base[2][4:], base[4][:-3], base[4]]
    roots = [0, 1, 2, 3, 4, 5, 6, 4]  # the last one is in a class with its like already
    for chunks in ([0] * 8, [0, 0, 0, 0, 0, 1, 1, 0]):
        rows = [(c, i, len(a), roots[i], jaccard.bitmap(a)) for i, (c, a) in enumerate(zip(chunks, arrays))]
        linked = {i for i in range(8) for j in range(8) if roots[i] != roots[j] and jaccard.similar(len(np.intersect1d(arrays[i], arrays[j])), len(arrays[i]), len(arrays[j]))}
        assert set(jaccard._may_link(rows, 80)) == linked == {2, 4, 5, 6, 7}
