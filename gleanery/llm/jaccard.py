"""Joining documents by the Jaccard similarity of their n-gram sets, exactly, in size-banded tiles.

Two sets can only be similar if their sizes are, so sets are banded by size, and a tile holds the sets of one band and of the band
below that share a shingle: one among each set's rarest, of which similar sets have one in common. A set's bitmap holds the parity
of its shingles' hashes, so the bits in which two bitmaps differ are at most the shingles in which the sets differ; counting them
bounds the overlap from above. Pairs that may still be similar are settled by intersecting their sorted arrays.

What counts are the classes of linked documents. Equal sets are one from the start. Then the members of each tile are held against
its first one; that settles tiles of two, joins most copies, and tiles whose sets are all in one class need no further look. What is
left is brought together by the first sets of the tiles, so that a group of copies that share many shingles meets once. There all
pairs of different classes are held against each other, in chunks of bounded size, until what is linked is one class.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import SENT_KEYS, broadcast_if_small, settled, text_hash
from gleanery.llm.graph import components
from gleanery.llm.packing import pack, unpack

WORDS = 5
PERCENT = 80
#: Counters of the sketch that says which shingles are rare, and the rows it is sent in.
SKETCH_BITS = 24
SLICES = 256
#: Sets and shingles of a chunk of a tile.
CHUNK = 2048
CHUNK_SHINGLES = 1 << 21
#: Texts and hashes handled at once.
STEP = 1 << 20
#: Words whose hashes a task remembers.
KNOWN = 1 << 20

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """64-bit hashes of words, kept as long as there are not too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def shingles(text: bytes, known: WordHashes, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text; of fewer words, one of the whole sequence; of none, none.

    Different shingles of a pair of texts have the same hash with a chance of about n^2 / 2^64.
    """
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    own = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    k = min(words, len(own))
    n = len(own) - k + 1
    out = own[:n] + np.uint64(k)
    for at in range(1, k):
        out = out * MULTIPLIER + own[at : at + n]
    out = (out ^ (out >> np.uint64(29))) * MIX
    return np.unique(out ^ (out >> np.uint64(32)))


def bitmap(found: np.ndarray) -> bytes:
    """Parity of the shingles that fall on each bit; four to eight bits a shingle, a power of two."""
    width = max(64, 1 << (4 * len(found) - 1).bit_length()) if len(found) else 64
    return np.packbits(np.bincount((found & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1).tobytes()


def differing(a: bytes, b: bytes) -> int:
    """Bits in which two bitmaps differ once the larger is folded to the size of the smaller: no more than their sets differ in."""
    if len(a) < len(b):
        a, b = b, a
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def similar(overlap, a, b, percent: int = PERCENT):
    return 100 * overlap >= percent * (a + b - overlap)


def may_be_similar(bits, a, b, percent: int = PERCENT):
    """Whether sets of sizes a and b, whose bitmaps differ in so many bits, can be similar."""
    return similar((a + b - bits) // 2, a, b, percent) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Of any order, the first so many elements of two similar sets have one in common."""
    return n - -(-percent * n // 100) + 1


def _texts(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        yield batch, [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column(column)]


def _key(found: np.ndarray) -> tuple[int, int]:
    data = found.tobytes()
    return tuple(int(np.uint64(xxhash.xxh3_64_intdigest(data, seed)).view(np.int64)) for seed in (1, 2))


SET_ROW = "slice int, id long, text_hash long, ref long, proof long, n long, counts binary"


def _sets(batches: Iterable[pa.RecordBatch], words: int, bits: int) -> Iterator[pa.RecordBatch]:
    """A row per document (id, text_hash, text) with its set's key and size; and at the end the task's part of the sketch, in which
    equal sets of a task count once."""
    known, seen = WordHashes(), set()
    counters, held, size = np.zeros(1 << bits, np.uint32), [], 0
    names = [f.split()[0] for f in SET_ROW.split(", ")]

    def add() -> None:
        at, n = np.unique(np.concatenate(held), return_counts=True)
        counters[at] += n.astype(np.uint32)
        held.clear()

    for batch, texts in _texts(batches, 2):
        rows = []
        for text in texts:
            found = shingles(text, known, words)
            ref, proof = _key(found)
            if ref not in seen:
                seen.add(ref)
                held.append((found >> np.uint64(64 - bits)).astype(np.int64))
                size += len(found)
                if size > 4 * STEP:
                    add()
                    size = 0
            rows.append((ref, proof, len(found)))
        refs, proofs, sizes = zip(*rows) if rows else ((),) * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1] * len(rows), pa.int32()), batch.column(0), batch.column(1), pa.array(refs, pa.int64()), pa.array(proofs, pa.int64()), pa.array(sizes, pa.int64()), pa.nulls(len(rows), pa.binary())], names
        )
    if held:
        add()
    each = len(counters) // SLICES
    parts = [(s, at) for s in range(SLICES) if len(at := np.flatnonzero(counters[s * each : (s + 1) * each]))]
    none = pa.nulls(len(parts), pa.int64())
    data = [pack(np.diff(at, prepend=0), counters[s * each + at]) for s, at in parts]
    yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in parts], pa.int32()), none, none, none, none, none, pa.array(data, pa.binary())], names)


def _added(batches: Iterable[pa.RecordBatch], each: int) -> Iterator[pa.RecordBatch]:
    """Of each slice of the sketch, the bit length of its counts added up over all tasks; rows are sorted by slice."""
    last, total = None, np.zeros(each, np.uint64)

    def out() -> pa.RecordBatch:
        length = np.zeros(each, np.uint8)
        for bit in range(64):
            length += (total >> np.uint64(bit) > 0).astype(np.uint8)
        return pa.RecordBatch.from_arrays([pa.array([last], pa.int32()), pa.array([length.tobytes()], pa.binary())], ["slice", "data"])

    for batch in batches:
        for piece, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if piece != last:
                if last is not None:
                    yield out()
                last, total = piece, np.zeros(each, np.uint64)
            steps, counts = unpack(data)
            total[np.cumsum(steps)] += counts.astype(np.uint64)
    if last is not None:
        yield out()


def rarity(parts: DataFrame, bits: int) -> np.ndarray:
    """The class of every counter, 2^bits bytes whatever the input. It only orders shingles: any order finds the same links."""
    each = (1 << bits) // SLICES
    sorted_ = parts.repartition("slice").sortWithinPartitions("slice")
    out = np.zeros(1 << bits, np.uint8)
    for row in sorted_.mapInArrow(lambda b: _added(b, each), "slice int, data binary").toLocalIterator():
        out[row.slice * each : (row.slice + 1) * each] = np.frombuffer(row.data, np.uint8)
    return out


def _prefixes(batches: Iterable[pa.RecordBatch], sent, words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """(shingle, ref, n): the rarest shingles of each set, once for all equal sets of a task."""
    known, seen, out, size, classes = WordHashes(), set(), [], 0, np.frombuffer(sent.value, np.uint8)
    shift = np.uint64(65 - len(classes).bit_length())

    def flush() -> pa.RecordBatch:
        rows = [np.concatenate([o[i] for o in out]) for i in range(3)]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(r) for r in rows], ["shingle", "ref", "n"])

    for _, texts in _texts(batches, 0):
        for text in texts:
            found = shingles(text, known, words)
            ref = _key(found)[0]
            if ref in seen or not len(found):
                continue
            seen.add(ref)
            rare = found[np.argsort(classes[found >> shift], kind="stable")[: prefix_length(len(found), percent)]].view(np.int64)
            out.append((rare, np.full(len(rare), ref), np.full(len(rare), len(found))))
            size += len(rare)
            if size > STEP:
                yield flush()
                size = 0
    if out:
        yield flush()


STAR = "lead long, lead_n long, band int, ref long, n long, more boolean"


def _stars(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The tiles of entries (shingle, ref, n) sorted by shingle and ref: a row for each set beside the first one of its tile.

    ``more`` says that a tile has more than two sets; of a shingle that may go on in the next batch it is taken to have.
    """
    last, leads = None, {}  # the last shingle, and of its tiles the first set, its size and the number of sets
    before = None
    for batch in batches:
        s, r, n = (c.to_numpy() for c in batch.columns)
        if not len(s):
            continue
        new = np.concatenate([[before != (s[0], r[0])], (s[1:] != s[:-1]) | (r[1:] != r[:-1])])
        before = (s[-1], r[-1])
        s, r, n = s[new], r[new], n[new]
        if not len(s):
            continue
        # A set stands in its own band's tile and, for larger ones, in that of the band above.
        band = np.floor(np.log(n) / np.log(100 / percent) + 1e-9).astype(np.int64)
        s, band, r, n = np.concatenate([s, s]), np.concatenate([band, band + 1]), np.concatenate([r, r]), np.concatenate([n, n])
        order = np.lexsort((r, band, s))
        s, band, r, n = s[order], band[order], r[order], n[order]
        starts = np.flatnonzero(np.concatenate([[True], (s[1:] != s[:-1]) | (band[1:] != band[:-1])]))
        sizes = np.diff(np.append(starts, len(s)))
        lead, lead_n, total = r[starts], n[starts], sizes.copy()
        known = np.zeros(len(starts), bool)
        for g in np.flatnonzero(s[starts] == last) if last is not None else ():
            if int(band[starts[g]]) in leads:
                lead[g], lead_n[g], m = leads[int(band[starts[g]])]
                total[g] += m
                known[g] = True
        end = s.max()
        if end != last:
            leads = {}
        for g in np.flatnonzero(s[starts] == end):
            leads[int(band[starts[g]])] = (lead[g], lead_n[g], total[g])
        last = end
        group = np.repeat(np.arange(len(starts)), sizes)
        beside = known[group]
        beside |= np.arange(len(s)) != starts[group]
        g = group[beside]
        more = (total[g] > 2) | (s[beside] == end)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lead[g]), pa.array(lead_n[g]), pa.array(band[beside].astype(np.int32)), pa.array(r[beside]), pa.array(n[beside]), pa.array(more)], [f.split()[0] for f in STAR.split(", ")]
        )


def _payloads(batches: Iterable[pa.RecordBatch], words: int, make: Callable[[np.ndarray], bytes]) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    for batch, texts in _texts(batches, 1):
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([make(shingles(t, known, words)) for t in texts], pa.binary())], ["ref", "data"])


def _bounded(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, na, nb, da, db) that their bitmaps don't rule out."""
    for batch in batches:
        na, nb = (batch.column(i).to_numpy() for i in (2, 3))
        bits = np.array([differing(x, y) for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())], np.int64)
        keep = pa.array(np.flatnonzero(may_be_similar(bits, na, nb, percent)))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep)], ["a", "b"])


def _intersected(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, x, y) of sorted arrays that are similar."""
    for batch in batches:
        keep = []
        for i, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            if similar(_overlap(x, y), len(x), len(y), percent):
                keep.append(i)
        keep = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep)], ["a", "b"])


def _link_tile(rows: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Links that join all sets (chunk, ref, n, root, array) of a tile that are linked and in different classes so far.

    Of a tile of two chunks, pairs of one chunk belong to that chunk's own tile.
    """
    rows = sorted(rows, key=lambda r: r[2])
    chunks, sizes, roots = (np.array([r[i] for r in rows]) for i in (0, 2, 3))
    labels = np.unique(roots, return_inverse=True)[1]
    arrays = [np.frombuffer(r[4], np.uint64) for r in rows]
    width = max(64, 1 << (8 * int(sizes[-1]) - 1).bit_length())
    maps = np.stack([np.packbits(np.bincount((x & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1).view(np.uint64) for x in arrays])
    across, found = len(np.unique(chunks)) > 1, []
    for i in range(len(rows) - 1):
        end = int(np.searchsorted(sizes, 100 * sizes[i] // percent, "right"))  # larger sets are too large
        at = np.arange(i + 1, end)
        at = at[(labels[at] != labels[i]) & (chunks[at] != chunks[i] if across else True)]
        if not len(at):
            continue
        bits = np.bitwise_count(maps[at] ^ maps[i]).sum(axis=1).astype(np.int64)
        may = may_be_similar(bits, sizes[at], sizes[i], percent)
        for j in at[may][np.argsort(bits[may], kind="stable")]:
            if labels[j] != labels[i] and similar(_overlap(arrays[i], arrays[j]), sizes[i], sizes[j], percent):
                labels[labels == labels[j]] = labels[i]
                found.append((rows[i][1], rows[j][1]))
    return found


def _folded(bits: bytes, size: int) -> np.ndarray:
    """A bitmap folded to so many bytes."""
    x = np.frombuffer(bits, np.uint8)
    while len(x) > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x.view(np.uint64)


def _may_link(rows: list[tuple], percent: int) -> list[int]:
    """Refs of the sets (chunk, ref, n, root, bitmap) of a tile whose bitmaps don't rule out a link to a set of another class there."""
    rows = sorted(rows, key=lambda r: r[2])
    chunks, sizes, roots = (np.array([r[i] for r in rows]) for i in (0, 2, 3))
    labels = np.unique(roots, return_inverse=True)[1]
    least = min(len(r[4]) for r in rows)
    maps = np.stack([_folded(r[4], least) for r in rows])
    across, marked = len(np.unique(chunks)) > 1, np.zeros(len(rows), bool)
    for i in range(len(rows) - 1):
        at = np.arange(i + 1, int(np.searchsorted(sizes, 100 * sizes[i] // percent, "right")))
        at = at[(labels[at] != labels[i]) & (chunks[at] != chunks[i] if across else True) & ~(marked[at] & marked[i])]
        if not len(at):
            continue
        bits = np.bitwise_count(maps[at] ^ maps[i]).sum(axis=1).astype(np.int64)
        may = at[may_be_similar(bits, sizes[at], sizes[i], percent)]
        marked[may] = True
        marked[i] |= len(may) > 0
    return [rows[i][1] for i in np.flatnonzero(marked)]


def _overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Common elements of two sorted arrays."""
    if len(x) > len(y):
        x, y = y, x
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(x) else 0


def _tiles(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Key and sets (chunk, ref, n, root, data) of each tile with several classes from rows (lead, band, lo, hi, chunk, ...) sorted by tile."""
    held: list[tuple] = []
    key = None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:4] != key:
                if len({r[3] for r in held}) > 1:
                    yield key, held
                held, key = [], row[:4]
            held.append(row[4:])
    if len({r[3] for r in held}) > 1:
        yield key, held


def _tile_members(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Sets (lead, band, ref) of each tile that may link to a set of another class."""
    for key, held in _tiles(batches):
        found = _may_link(held, percent)
        yield pa.RecordBatch.from_arrays([pa.array([key[0]] * len(found), pa.int64()), pa.array([key[1]] * len(found), pa.int32()), pa.array(found, pa.int64())], ["lead", "band", "ref"])


def _tile_links(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links of each tile."""
    for _, held in _tiles(batches):
        found = _link_tile(held, percent)
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])


def _in_tiles(members: DataFrame, data: DataFrame, chunk: int) -> DataFrame:
    """The sets of each tile with their data, tiles of more sets than a chunk as pairs of chunks, side by side and sorted."""
    sizes = members.groupBy("lead", "band").agg(F.ceil(F.greatest(F.count("*") / chunk, F.sum("n") / CHUNK_SHINGLES)).alias("chunks"))
    placed = members.join(sizes, ["lead", "band"]).withColumn("chunk", F.pmod(F.xxhash64("ref"), F.col("chunks"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    cut = placed.join(data, "ref").select("lead", "band", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "chunk", "ref", "n", "root", "data")
    key = ["lead", "band", "lo", "hi"]
    return cut.repartition(*key).sortWithinPartitions(*key)


def _read(refs: DataFrame, sets: DataFrame, docs: DataFrame, words: int, make: Callable[[np.ndarray], bytes] = np.ndarray.tobytes) -> DataFrame:
    """(ref, data): sorted arrays of some sets (ref), or what else is made of them, from one text of each. No other text is read into a set."""
    needed = refs.distinct().join(sets, "ref").select("ref", F.col("rep.id").alias("rep_id"), F.col("rep.text_hash").alias("rep_hash"))
    needed = broadcast_if_small(settled(needed), SENT_KEYS)
    texts = docs.join(needed, docs["id"].eqNullSafe(needed["rep_id"]) & (docs["text_hash"] == needed["rep_hash"])).select("ref", "text")
    return settled(texts.mapInArrow(lambda b: _payloads(b, words, make), "ref long, data binary").groupBy("ref").agg(F.first("data").alias("data")))


def jaccard_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT, bits: int = SKETCH_BITS, chunk: int = CHUNK) -> DataFrame:
    """A row per row of ``docs``: id, text_hash, n_shingles, class and component_id.

    A document's set are its distinct ``words``-word shingles in lower case (A-Z); of fewer words, the whole sequence. Documents
    link when their sets' Jaccard similarity is ``percent`` percent or more. Texts without words, empty and null ones link with
    nothing, not even with each other. component_id is the smallest id that is reached; rows without an id take part, but give no
    id. Repeated rows link like any equal texts. An empty table gives an empty table; other columns aren't read. Two different sets
    with one 64-bit key fail the job.
    """
    given = docs.select(F.col(doc_id).cast("long").alias("id"), text_hash(text).alias("text_hash"), F.col(text).alias("text"))
    scanned = settled(given.mapInArrow(lambda b: _sets(b, words, bits), SET_ROW))
    rows = scanned.where("slice < 0").select("id", "text_hash", "ref", "proof", "n")
    proof = F.when(F.min("proof") == F.max("proof"), F.min("n")).otherwise(F.raise_error(F.lit("two sets have one key")))
    rep = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("rep")
    sets = settled(rows.where("n > 0").groupBy("ref").agg(proof.alias("n"), rep, F.min("id").alias("least")))

    context = docs.sparkSession.sparkContext
    sent = context.broadcast(rarity(scanned.where("slice >= 0").select("slice", "counts"), bits).tobytes())
    entries = given.select("text").mapInArrow(lambda b: _prefixes(b, sent, words, percent), "shingle long, ref long, n long")
    sorted_ = entries.repartition("shingle").sortWithinPartitions("shingle", "ref")
    drawn = sorted_.mapInArrow(lambda b: _stars(b, percent), STAR)
    # Sets share many shingles with their copies: a pair counts once.
    stars = settled(drawn.groupBy("lead", "band", "ref").agg(F.max("lead_n").alias("lead_n"), F.max("n").alias("n"), F.bool_or("more").alias("more")))
    sent.destroy()

    near = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    pairs = settled(stars.select(F.col("lead").alias("a"), F.col("ref").alias("b"), F.col("lead_n").alias("na"), F.col("n").alias("nb")).where(near).distinct())
    both = lambda pairs, data: pairs.join(data.withColumnsRenamed({"ref": "a", "data": "da"}), "a").join(data.withColumnsRenamed({"ref": "b", "data": "db"}), "b")
    ends = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("ref"))
    bounded = both(pairs, _read(ends(pairs), sets, given, words, bitmap)).select("a", "b", "na", "nb", "da", "db")
    pairs = settled(bounded.mapInArrow(lambda b: _bounded(b, percent), "a long, b long"))
    first = settled(both(pairs, _read(ends(pairs), sets, given, words)).select("a", "b", "da", "db").mapInArrow(lambda b: _intersected(b, percent), "a long, b long"))
    classes = settled(components(first)).withColumnsRenamed({"node": "ref"})

    # Both sets of a tile of two have been held against each other. Tiles with one first set are one from here on.
    large = stars.where("more")
    members = large.select("lead", "band", "ref", "n").unionByName(large.select("lead", "band", F.col("lead").alias("ref"), F.col("lead_n").alias("n"))).distinct()
    rooted = members.join(classes, "ref", "left").withColumn("root", F.coalesce("root", "ref"))
    mixed = rooted.groupBy("lead", "band").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most").select("lead", "band")
    members = settled(rooted.join(mixed, ["lead", "band"]))
    # Bitmaps stand for the sets first: arrays, many times as large, are dealt out only for sets that may still link to another class.
    mapped = _in_tiles(members, _read(members.select("ref"), sets, given, words, bitmap), chunk)
    may = mapped.mapInArrow(lambda b: _tile_members(b, percent), "lead long, band int, ref long").distinct()
    members = settled(members.join(may, ["lead", "band", "ref"], "left_semi"))
    cut = _in_tiles(members, _read(members.select("ref"), sets, given, words), chunk)
    more = settled(cut.mapInArrow(lambda b: _tile_links(b, percent), "a long, b long"))
    links = more.unionByName(classes.select(F.col("ref").alias("a"), F.col("root").alias("b")))

    whole = settled(components(links)).withColumnsRenamed({"node": "ref"})
    linked = settled(sets.join(whole, "ref", "left").select("ref", F.coalesce("root", "ref").alias("class"), "least"))
    least = linked.groupBy("class").agg(F.min("least").alias("component_id"))
    out = rows.join(linked.drop("least").join(least, "class"), "ref", "left")
    return out.select("id", "text_hash", F.col("n").alias("n_shingles"), "class", F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def op11(docs: DataFrame) -> DataFrame:
    """Set size and component of every document."""
    return jaccard_classes(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
