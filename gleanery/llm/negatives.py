"""Hard negatives by exact inner product search over length buckets with sorted coordinate lists.

Rows of a label are cut into buckets in order of length, longest first. A bucket is skipped for an anchor if its longest row
can't reach the score that is still of use. Else that score, as a cosine against the longest row, gives for each of the anchor's
focus coordinates (its largest) the range of values that a row's own coordinate may have. The narrowest range is cut out of that
coordinate's sorted list, the other ranges are held against what it names, and what is left is verified by its exact score.
Anchors whose ranges leave most of a bucket verify all of it, together, in one product.

The work is dealt in tiles of a bounded number of rows and anchors. Each tile keeps its best few for each anchor, and those are
ranked once more over all tiles.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.common import broadcast_if_small, settled

SCALE = 256
POSITIVES = NEGATIVES = 5
LOW, HIGH = 80, 100
#: Rows of a bucket, buckets of a tile, and anchors of a tile.
BUCKET, BUCKETS, ANCHORS = 4096, 8, 32768
FOCUS = 3
#: Anchors verified in one product.
TOGETHER = 256
SLACK = 1e-7
NO_ID = np.iinfo(np.int64).max
NEVER = np.iinfo(np.int64).min

FOUND = "anchor_id long, anchor_row long, slot int, found_id long, score long"


def _packed(row: np.ndarray) -> bytes:
    """Integers in the least width that holds them, which the first byte names."""
    most = int(np.abs(row).max()) if row.size else 0
    width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w - 1))
    return bytes([width]) + row.astype(f"<i{width}").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[0]}", offset=1)


def _whole(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """Rows (vec_id, label, vector) whose components are all finite, with the vector in integers, its length and its norm."""
    for batch in batches:
        lists = batch.column(2)
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
        keep = np.flatnonzero(bad[ends] == bad[starts])
        scaled = np.floor(scale * np.where(np.isfinite(values), values, 0))
        if scaled.size and np.abs(scaled).max() >= 1 << 31:
            raise OverflowError(f"a component is beyond {(1 << 31) // scale}: its scores don't fit 64 bits")
        rows = [scaled[starts[i] : ends[i]].astype(np.int64) for i in keep]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(keep)), batch.column(1).take(pa.array(keep)), pa.array([len(r) for r in rows], pa.int32()),
             pa.array([float(np.sqrt(np.square(r.astype(np.float64)).sum())) for r in rows], pa.float64()), pa.array([_packed(r) for r in rows], pa.binary())],
            ["vec_id", "label", "dim", "norm", "packed"],
        )


def integer_vectors(vectors: DataFrame, vec_id: str, label: str | Column, vector: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, dim, norm, packed): the rows that take part, repeated ones once."""
    label = F.col(label) if isinstance(label, str) else label
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    whole = rows.where("label IS NOT NULL AND vector IS NOT NULL").mapInArrow(lambda b: _whole(b, scale), "vec_id long, label long, dim int, norm double, packed binary")
    return whole.dropDuplicates(["vec_id", "label", "packed"])


def _buckets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Buckets of rows sorted by dim, label and falling norm."""
    held: list[tuple] = []

    def out() -> pa.RecordBatch:
        matrix = np.stack([_unpacked(r[4]).astype(np.int64) for r in held])
        ids = np.array([NO_ID if r[0] is None else r[0] for r in held], np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array([held[0][2]], pa.int32()), pa.array([held[0][1]], pa.int64()), pa.array([held[0][3]], pa.float64()), pa.array([ids.tobytes()], pa.binary()), pa.array([_packed(matrix.ravel())], pa.binary())],
            ["dim", "label", "norm", "ids", "matrix"],
        )

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and (row[1:3] != held[0][1:3] or len(held) == size):
                yield out()
                held = []
            held.append(row)
    if held:
        yield out()


def length_buckets(rows: DataFrame, size: int = BUCKET, together: int = BUCKETS) -> DataFrame:
    """(dim, label, norm, ids, matrix, tile): buckets of at most ``size`` rows of a label, in order of length.

    Ranges are cut by id as well, so neither a hot label nor one vector in many rows is one task.
    """
    by = ["dim", "label", F.col("norm").desc(), "vec_id", F.xxhash64("packed")]
    cut = rows.repartitionByRange(*by).sortWithinPartitions(*by).select("vec_id", "label", "dim", "norm", "packed")
    buckets = settled(cut.mapInArrow(lambda b: _buckets(b, size), "dim int, label long, norm double, ids binary, matrix binary"))
    return buckets.withColumn("tile", F.floor(F.monotonically_increasing_id() / together))


class Bucket:
    """Rows of one label with a sorted list of each coordinate of their unit vectors."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        self.ids, self.matrix = ids, matrix
        norms = np.sqrt(np.square(matrix.astype(np.float64)).sum(axis=1))
        self.longest = float(norms.max())
        self.unit = matrix / np.where(norms > 0, norms, 1)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """Values of coordinate f in order, and whose they are."""
        if f not in self.lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.lists[f] = self.unit[order, f], order
        return self.lists[f]

    def candidates(self, unit: np.ndarray, least: np.ndarray) -> list[np.ndarray | None]:
        """For unit anchors and the cosines that a row needs: the rows whose focus coordinates lie in their feasible ranges.

        None for an anchor whose narrowest range holds half of the rows or more, or that needs no positive cosine.
        """
        focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
        if not focus.size:
            return [None] * len(unit)
        angle = np.arccos(np.clip(np.take_along_axis(unit, focus, 1), -1, 1))
        reach = np.arccos(np.clip(least, -1, 1))[:, None]
        low, high = np.cos(np.minimum(np.pi, angle + reach)) - SLACK, np.cos(np.maximum(0, angle - reach)) + SLACK
        begin, end = np.empty(focus.shape, np.int64), np.empty(focus.shape, np.int64)
        for f in np.unique(focus):
            at = focus == f
            values = self.list(f)[0]
            begin[at], end[at] = np.searchsorted(values, low[at]), np.searchsorted(values, high[at], "right")
        width = end - begin
        narrow = width.argmin(axis=1)
        out: list[np.ndarray | None] = []
        for i, j in enumerate(narrow):
            if least[i] <= 0 or 2 * width[i, j] >= len(self.ids):
                out.append(None)
                continue
            rows = self.list(focus[i, j])[1][begin[i, j] : end[i, j]]
            for other, f in enumerate(focus[i]):
                if other != j:
                    own = self.unit[rows, f]
                    rows = rows[(own >= low[i, other]) & (own <= high[i, other])]
            out.append(rows)
        return out


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors; as doubles where all sums stay below 2^53."""
    most = lambda m: int(np.abs(m).max()) if m.size else 0
    bound = most(anchors) * most(rows) * max(anchors.shape[1], 1)
    if bound < 1 << 53:
        return (anchors.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    if bound >= 1 << 63:
        raise OverflowError("scores don't fit 64 bits")
    return anchors @ rows.T


class Slots:
    """The best few rows of each slot: of an anchor, those with scores from ``floor`` to ``cap``; ties by smaller id."""

    def __init__(self, floor: np.ndarray, cap: np.ndarray, k: int):
        self.floor, self.cap, self.k = floor, cap, k
        self.found = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(floor)
        self.least = floor.copy()

    def offer(self, slot: int, score: np.ndarray, ids: np.ndarray) -> None:
        fits = np.flatnonzero((score >= self.least[slot]) & (score <= self.cap[slot]))
        if not len(fits):
            return
        if len(fits) > 4 * self.k:
            own = score[fits]
            fits = fits[own >= np.partition(own, len(own) - self.k)[len(own) - self.k]]
        s, i = (np.concatenate([a, b[fits]]) for a, b in zip(self.found[slot], (score, ids)))
        first = np.lexsort((i, -s))[: self.k]
        self.found[slot] = s[first], i[first]
        if len(first) == self.k:
            self.least[slot] = max(self.floor[slot], s[first[-1]])


def search_tile(buckets: list[tuple[int, np.ndarray, np.ndarray]], anchors: np.ndarray, labels: np.ndarray, slots: Slots, first: np.ndarray, same: bool, own: list[tuple[int, np.ndarray]]) -> None:
    """Offer to each anchor's slots (``first[i]`` to ``first[i + 1]``) the rows of its own label, or of all others, that may fit.

    ``own`` names each anchor's id and vector, so that it isn't found itself.
    """
    norms = np.sqrt(np.square(anchors.astype(np.float64)).sum(axis=1))
    unit = anchors / np.where(norms > 0, norms, 1)[:, None]
    for label, ids, matrix in buckets:
        bucket = Bucket(ids, matrix)
        asked = np.flatnonzero(((labels == label) == same) & (np.diff(first) > 0))
        if not len(asked):
            continue
        need = np.array([slots.least[first[i] : first[i + 1]].min() for i in asked])
        top = norms[asked] * bucket.longest * (1 + SLACK)
        open_ = (need <= 0) | (top >= need)
        asked, need, top = asked[open_], need[open_], top[open_]
        least = np.where(need > 0, need / np.where(top > 0, top, 1), 0.0)
        found = bucket.candidates(unit[asked], least)
        every = [i for i, rows in zip(asked, found) if rows is None]
        for at in range(0, len(every), TOGETHER):
            part = every[at : at + TOGETHER]
            for i, score in zip(part, scores(anchors[part], matrix)):
                _offer(slots, first, i, score, ids, matrix, own, same)
        for i, rows in zip(asked, found):
            if rows is not None and len(rows):
                _offer(slots, first, i, scores(anchors[i : i + 1], matrix[rows])[0], ids[rows], matrix[rows], own, same)


def _offer(slots: Slots, first: np.ndarray, i: int, score: np.ndarray, ids: np.ndarray, matrix: np.ndarray, own: list[tuple[int, np.ndarray]], same: bool) -> None:
    if same:
        me = np.flatnonzero(ids == own[i][0])
        me = me[(matrix[me] == own[i][1]).all(axis=1)]
        if len(me):
            score, ids = np.delete(score, me), np.delete(ids, me)
    for slot in range(first[i], first[i + 1]):
        slots.offer(slot, score, ids)


def _tiles(anchors: DataFrame, buckets: DataFrame, k: int, same: bool, low: int, together: int = ANCHORS) -> DataFrame:
    """``FOUND`` rows: of each tile the best ``k`` rows of every slot.

    ``anchors`` are (vec_id, anchor_row, label, dim, packed, caps): a slot for each cap, with floor ``low`` percent of it.
    """
    groups = max(1, ceil(anchors.count() / together))
    tiles = broadcast_if_small(settled(buckets.select("tile", "dim").distinct()))
    left = anchors.withColumn("group", F.pmod(F.xxhash64("anchor_row"), F.lit(groups))).join(tiles, "dim")
    right = buckets.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    left = left.select("tile", "group", "dim", "vec_id", "anchor_row", "label", "packed", "caps")
    right = right.select("tile", "group", "dim", "label", "norm", "ids", "matrix")

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if a.num_rows and b.num_rows:
            dims = np.array(b.column("dim").to_pylist())
            held = a.to_pydict()
            for dim in np.unique(dims):
                rows = sorted((r for r in b.to_pylist() if r["dim"] == dim), key=lambda r: -r["norm"])
                found = [(r["label"], np.frombuffer(r["ids"], np.int64), _unpacked(r["matrix"]).astype(np.int64).reshape(len(r["ids"]) // 8, dim)) for r in rows]
                at = [i for i, d in enumerate(held["dim"]) if d == dim]
                if not at:
                    continue
                vectors = np.stack([_unpacked(held["packed"][i]).astype(np.int64) for i in at]).reshape(len(at), dim)
                caps = [held["caps"][i] for i in at]
                first = np.cumsum([0, *(len(c) for c in caps)])
                cap = np.array([NO_ID if c is None else c for own in caps for c in own], np.int64)
                floor = np.array([NEVER if c is None else -(-low * c // 100) for own in caps for c in own], np.int64)
                slots = Slots(floor, cap, k)
                search_tile(found, vectors, np.array([held["label"][i] for i in at]), slots, first, same, [(held["vec_id"][i], v) for i, v in zip(at, vectors)])
                for j, i in enumerate(at):
                    for slot in range(first[j], first[j + 1]):
                        out += [(held["vec_id"][i], held["anchor_row"][i], slot - first[j], None if r == NO_ID else int(r), int(s)) for s, r in zip(*slots.found[slot])]
        columns = list(zip(*out)) or [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        return pa.Table.from_arrays([pa.array([None if v is None else int(v) for v in c], kind) for c, kind in zip(columns, kinds)], names=[f.split()[0] for f in FOUND.split(", ")])

    return left.groupBy("tile", "group").cogroup(right.groupBy("tile", "group")).applyInArrow(run, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each slot over all tiles, with their rank from 1."""
    best = Window.partitionBy("anchor_id", "anchor_row", "slot").orderBy(F.desc("score"), F.col("found_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, anchor: Column, vec_id: str = "vec_id", label: str | Column = "label", vector: str = "embedding",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, scale: int = SCALE, bucket: int = BUCKET,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components count as ``floor(scale * x)``, and a score is the inner product of such vectors. ``anchor`` is a condition over
    ``vec_id``. An anchor's positives are its best other rows of its label; for each, its negatives are the best rows of other
    labels that score from ``low`` percent of the positive's score to that score.

    Rows with a null label, a null vector or a null or non-finite component take no part. Repeated rows count once; rows that
    share an id only are rows of their own. Rows without an id are found, after the others among ties, and are no anchors. Vectors
    meet those with as many components. Below zero no score lies in the band, so such positives have no negatives. An empty table
    gives an empty table; other columns aren't read. A component of 2^31 / scale or more fails the job.
    """
    rows = settled(integer_vectors(vectors, vec_id, label, vector, scale))
    buckets = length_buckets(rows, bucket)
    asking = settled(rows.where(anchor).where("vec_id IS NOT NULL").withColumn("anchor_row", F.xxhash64("vec_id", "label", "packed")).drop("norm"))
    none = F.array(F.lit(None).cast("long"))
    found = settled(_ranked(_tiles(asking.withColumn("caps", none), buckets, positives, True, low), positives))
    pairs = found.withColumnsRenamed({"found_id": "positive_id", "score": "positive_score"}).where("positive_score >= 0")
    # Positives of one score have the same negatives and share a slot.
    caps = pairs.groupBy("anchor_id", "anchor_row").agg(F.sort_array(F.collect_set("positive_score")).alias("caps"))
    wanted = asking.join(caps.drop("anchor_id"), "anchor_row")
    best = _ranked(_tiles(wanted, buckets, negatives, False, low), negatives).withColumnsRenamed({"found_id": "negative_id", "score": "negative_score"})
    placed = pairs.drop("slot", "rank").join(caps.drop("anchor_id"), "anchor_row").withColumn("slot", (F.array_position("caps", F.col("positive_score")) - 1).cast("int"))
    return placed.join(best, ["anchor_id", "anchor_row", "slot"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op12(embeddings: DataFrame, **options) -> DataFrame:
    """Hard negatives of every hundredth vector against all."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(embeddings, F.col("vec_id") % 100 == 0, label=label, **options)


OP12_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, a.v AS anchor, b.vec_id, b.label, b.v,
    CASE WHEN len(a.v) = len(b.v) THEN list_dot_product(a.v, b.v) END::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND (a.vec_id IS DISTINCT FROM b.vec_id OR a.label <> b.label OR a.v <> b.v)),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id, own, anchor ORDER BY score DESC, vec_id NULLS LAST) AS place
  FROM scored WHERE own = label AND score IS NOT NULL QUALIFY place <= 5),
negatives AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.own, p.anchor, p.place ORDER BY n.score DESC, n.vec_id NULLS LAST)::INTEGER AS rank
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND n.own = p.own AND n.anchor = p.anchor AND n.label <> n.own
    AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5
"""
