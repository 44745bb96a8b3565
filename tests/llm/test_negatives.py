"""Hard negatives against a plain scan, with rows where the coordinate ranges leave little, and awkward rows."""

import sys
from pathlib import Path

import numpy as np
import pytest

from gleanery.llm import negatives

sys.path.insert(0, str(Path(__file__).resolve().parent))
import plain  # noqa: E402

SCHEMA = "vec_id long, label int, embedding array<float>, norm string, tile int, packed string, score double"
EXTRA = ("x", 1, "y", 0.5)


def given(spark, rows):
    return spark.createDataFrame([(i, label, v if v is None else [None if x is None else float(x) for x in v], *EXTRA) for i, label, v in rows], SCHEMA)


def found(df):
    return sorted((tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=repr)


def clustered(n, dim, spread, seed):
    """Vectors around a few centres shared by all labels, of very different lengths."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    vectors = (centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, dim))) * rng.choice([0.05, 0.5, 1.0, 3.0], n)[:, None]
    return [(i * 25, int(rng.integers(0, 3)), v.astype(np.float32).tolist()) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("bucket, tiles, together", [(8, 2, 7), (64, 8, 32768)])
def test_negatives(spark, monkeypatch, bucket, tiles, together):
    monkeypatch.setattr(negatives._tiles, "__defaults__", (together,))
    monkeypatch.setattr(negatives.length_buckets, "__defaults__", (bucket, tiles))
    rows = clustered(400, 12, 0.1, bucket)
    assert found(negatives.op12(given(spark, rows), bucket=bucket)) == plain.negatives(rows)


def test_ranges_prune_and_lose_nothing():
    rng = np.random.default_rng(3)
    matrix = np.floor(256 * (np.eye(8)[rng.integers(0, 8, 2000)] + 0.05 * rng.normal(size=(2000, 8)))).astype(np.int64)
    bucket = negatives.Bucket(np.arange(2000), matrix)
    unit = bucket.unit[:50]
    left = 0
    for least in (0.3, 0.8, 0.95, 0.999):
        for q, rows in zip(unit, bucket.candidates(unit, np.full(50, least))):
            fits = np.flatnonzero(bucket.unit @ q >= least)
            if rows is not None:
                left += 1
                assert set(fits) <= set(rows.tolist()) and len(rows) < 1000
    assert left >= 100


def test_awkward_rows(spark):
    one, far = [1.0, 0.0, 0.5], [float("nan"), 0.0, 0.0]
    rows = [
        (0, 1, one), (0, 1, one), (0, 2, one), (1, 2, one), (2, 2, one), (3, 1, one), (4, 1, [0.9, 0.1, 0.5]), (5, None, one), (6, 1, None),
        (8, 1, far), (9, 2, [float("inf"), 0.0, 0.0]), (10, 2, [None, 1.0, 1.0]), (11, 2, [0.0, 0.0, 0.0]), (100, 3, [0.0, 0.0, 0.0]), (101, 3, [0.0, 0.0, 0.0]),
        (200, 1, []), (201, 1, []), (202, 2, []), (None, 1, one), (None, 2, one), (-100, 1, [-1.0, 0.0, 0.0]), (300, 5, [1.0, 2.0]), (7, 1, one), (14, 9, one),
    ] + [(1000 + i, 2, one) for i in range(1, 60)]
    assert found(negatives.op12(given(spark, rows))) == plain.negatives(rows)
    kinds = [f.dataType.simpleString() for f in negatives.op12(given(spark, rows)).schema]
    assert kinds == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]


def test_no_rows(spark):
    for rows in ([], [(0, None, [1.0])], [(0, 1, [1.0])], [(3, 1, [1.0])]):
        assert found(negatives.op12(given(spark, rows))) == []


def test_scores_beyond_doubles():
    big = np.array([[1 << 30, 3]], np.int64)
    assert negatives.scores(big, big)[0, 0] == (1 << 60) + 9
    with pytest.raises(OverflowError):
        negatives.scores(big << 2, big << 2)
