"""Character n-gram models by modified Kneser-Ney smoothing, counted in Spark and kept in sorted hash arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.common import broadcast_if_small, release_memory, settled
from gleanery.llm.packing import pack, unpack

ORDER = 5
#: Bits of a symbol.
SYMBOL_BITS = 12
DIRECTORY_BITS = 20
BEGIN, END = 2, 3
UNIFORM = 1.0 / (1 << SYMBOL_BITS)
STEP = 1 << 18
#: Distinct n-grams that a task holds before it passes them on.
MOST = 1 << 21
#: Hash parts in which counts are added up.
PARTS = 64


def symbols(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of some texts in one array, each text after ``order - 1`` begin marks and before an end mark; and their lengths.

    Texts are in lower case with white space in one piece. Code points from 2,048 on share as many symbols by a hash.
    """
    plain = [" ".join(t.lower().split()).replace(chr(BEGIN), " ") for t in texts]
    pad = chr(BEGIN) * (order - 1)
    points = np.frombuffer((pad + (chr(END) + pad).join(plain) + chr(END)).encode("utf-32-le", "replace"), np.uint32)
    half = 1 << (SYMBOL_BITS - 1)
    return np.where(points < half, points, half + (points * np.uint32(40503) >> np.uint32(7)) % half).astype(np.uint16), np.array([len(t) + 1 for t in plain], np.int64)


def grams(codes: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """Keys of the n-grams that end at each symbol but begin marks, some at a time; the last symbol has the lowest bits."""
    for at in range(order - 1, len(codes), STEP):
        part = codes[at - order + 1 : at + STEP].astype(np.int64)
        n = len(part) - order + 1
        keys = part[order - 1 :].copy()
        for back in range(1, order):
            keys |= part[order - 1 - back : order - 1 - back + n] << (SYMBOL_BITS * back)
        yield keys[part[order - 1 :] != BEGIN]


def slots(keys: np.ndarray, lang: str, order: int) -> np.ndarray:
    """64-bit hashes of the n-grams of a language and order, without collisions among these."""
    salt = np.uint64(int.from_bytes(hashlib.blake2b(f"{order}|{lang}".encode(), digest_size=8).digest(), "big"))
    h = (keys.astype(np.uint64) ^ salt) * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def pieces(batches: Iterable[pa.RecordBatch], size: int = STEP) -> Iterator[tuple[list[str], list[str]]]:
    """Languages and texts of rows (lang, text), about ``size`` characters at a time."""
    langs, texts, n = [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            langs.append(lang or "")
            texts.append(text.as_buffer().to_pybytes().decode("utf-8", "replace") if text.is_valid else "")
            n += len(texts[-1])
            if n >= size:
                yield langs, texts
                langs, texts, n = [], [], 0
    if langs:
        yield langs, texts


def by_lang(langs: list[str]) -> dict[str, list[int]]:
    rows: dict[str, list[int]] = {}
    for i, lang in enumerate(langs):
        rows.setdefault(lang, []).append(i)
    return rows


def _counted(batches: Iterable[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    """n-gram counts of a task."""
    release_memory()  # of tasks before
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    merge = lambda parts: _sum(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))

    def out(lang: str) -> Iterator[pa.RecordBatch]:
        keys, counts = merge(held.pop(lang))
        part = (keys * -7046029254386353131 >> 58) & (PARTS - 1)
        rows = [(p, lang, pack(np.diff(keys[own], prepend=0), counts[own])) for p in range(PARTS) if (own := part == p).any()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows], pa.binary())], ["part", "lang", "payload"])

    for langs, texts in pieces(batches):
        for lang, rows in by_lang(langs).items():
            for keys in grams(symbols([texts[i] for i in rows], order)[0], order):
                held.setdefault(lang, []).append(np.unique(keys, return_counts=True))
            if len(held[lang]) > 16:
                held[lang] = [merge(held[lang])]
                if len(held[lang][0][0]) > MOST:
                    yield from out(lang)
    for lang in list(held):
        yield from out(lang)
    release_memory()


def _added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each n-gram from what the tasks counted, in rows sorted by part and language."""
    last, parts, size = None, [], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        return _sum(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))

    def out() -> Iterator[pa.RecordBatch]:
        keys, counts = merged()
        for at in range(0, len(keys), STEP):
            k, c = keys[at : at + STEP], counts[at : at + STEP]
            yield pa.RecordBatch.from_arrays([pa.array([last[1]] * len(k), pa.string()), pa.array(k), pa.array(c)], ["lang", "gram", "n"])

    for batch in batches:
        for part, lang, payload in zip(*(c.to_pylist() for c in batch.columns)):
            if (part, lang) != last:
                if parts:
                    yield from out()
                last, parts, size = (part, lang), [], 0
            steps, counts = unpack(payload)
            parts.append((np.cumsum(steps), counts))
            size += len(counts)
            if size > MOST:
                parts, size = [merged()], 0
    if parts:
        yield from out()


def _sum(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _discount(k: int) -> Column:
    """Discount of count k (3: three or more), from how many n-grams have the counts 1 to 4; 0.75 where those are too few."""
    n = [F.col(f"n{i}") for i in range(1, 5)]
    d = k - (k + 1) * F.try_divide(n[0], n[0] + 2 * n[1]) * F.try_divide(n[k], n[k - 1])
    return F.when((d > 0) & (d < k), d).otherwise(0.75)


def counts(docs: DataFrame, lang: str, text: str, order: int = ORDER) -> DataFrame:
    """(lang, gram, n) over all rows; null languages are the language ""."""
    found = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    sent = found.mapInArrow(lambda b: _counted(b, order), "part int, lang string, payload binary").repartition("part").sortWithinPartitions("part", "lang")
    return sent.mapInArrow(_added, "lang string, gram long, n long")


def entries(counted: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, order, gram, n, logp, logb) of the n-grams of all orders: log probability, and log weight of what backs off from it.

    Lower orders count in how many ways an n-gram is continued to the left, as Kneser and Ney do; each order has three
    discounts for each language.
    """
    low = lambda m: F.col("gram").bitwiseAND((1 << (SYMBOL_BITS * m)) - 1)
    by_order = {order: settled(counted)}
    for m in range(order - 1, 0, -1):
        by_order[m] = by_order[m + 1].groupBy("lang", low(m).alias("gram")).agg(F.count("*").alias("n"))
    every = _together(c.withColumn("order", F.lit(m)) for m, c in by_order.items())
    few = every.groupBy("lang", "order").agg(*[F.count_if(F.col("n") == k).alias(f"n{k}") for k in range(1, 5)])
    discounts = broadcast_if_small(settled(few.select("lang", "order", *[_discount(k).alias(f"d{k}") for k in (1, 2, 3)])))
    context = Window.partitionBy("lang", "context")
    less = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    out, lower, weighed = [], None, {}
    for m in range(1, order + 1):
        cut = by_order[m].join(discounts.where(F.col("order") == m), "lang").select("lang", "gram", "n", F.shiftright("gram", SYMBOL_BITS).alias("context"), less.alias("less"))
        weighed[m] = cut.withColumn("s", F.sum("n").over(context)).withColumn("back", F.sum("less").over(context) / F.col("s"))
        if m == 1:
            below = weighed[m].withColumn("below", F.lit(UNIFORM))
        else:
            below = weighed[m].withColumn("suffix", low(m - 1)).join(lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("below")), ["lang", "suffix"])
        p = below.select("lang", "gram", "n", ((F.col("n") - F.col("less")) / F.col("s") + F.col("back") * F.col("below")).alias("p"))
        lower = p if m == order else settled(p)
        out.append(lower)
    named = []
    for m, p in enumerate(out, 1):
        if m < order:
            backs = weighed[m + 1].groupBy("lang", F.col("context").alias("gram")).agg(F.first("back").alias("back"))
            # Contexts of begin marks alone aren't n-grams themselves: nothing asks for their own probability.
            p = p.join(backs, ["lang", "gram"], "full")
        else:
            p = p.withColumn("back", F.lit(1.0))
        named.append(p.select("lang", F.lit(m).alias("order"), "gram", F.coalesce("n", F.lit(1)).alias("n"), F.log(F.coalesce("p", F.lit(1.0))).alias("logp"), F.log(F.coalesce("back", F.lit(1.0))).alias("logb")))
    # Order 0 is the chance of any one symbol that a language doesn't have.
    unseen = weighed[1].groupBy("lang").agg(F.log(F.first("back") * UNIFORM).alias("logp"))
    named.append(unseen.select("lang", F.lit(0).alias("order"), F.lit(0).cast("long").alias("gram"), F.lit(1).cast("long").alias("n"), "logp", F.lit(0.0).alias("logb")))
    return _together(named)


def _together(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


class Model:
    """Sorted 64-bit hashes with the log probability and back-off of each; an n-gram that isn't there is a miss."""

    def __init__(self, found: np.ndarray, logp: np.ndarray, logb: np.ndarray, order: int = ORDER):
        self.order = order
        self.slots = np.append(found, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.logp, self.logb = np.append(logp, np.float32(0)), np.append(logb, np.float32(0))

    def __len__(self) -> int:
        return len(self.slots) - 1

    def arrays(self) -> tuple:
        """What ``Model`` is made from."""
        return self.slots[:-1], self.logp[:-1], self.logb[:-1], self.order

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of hashes in the arrays, and whether they are there; the leading bits say where to begin."""
        if not hasattr(self, "directory"):
            self.directory = np.searchsorted(self.slots, np.arange(1 << DIRECTORY_BITS, dtype=np.uint64) << np.uint64(64 - DIRECTORY_BITS))
        at = self.directory[wanted >> np.uint64(64 - DIRECTORY_BITS)]
        while True:
            before = self.slots[at] < wanted
            if not before.any():
                return at, (self.slots[at] == wanted) & (at < len(self))
            at += before

    def log_probabilities(self, keys: np.ndarray, lang: str) -> np.ndarray:
        """Of the last symbols of n-grams of the highest order; what isn't found backs off."""
        out, left, weight, m = np.zeros(len(keys), np.float32), np.arange(len(keys)), np.zeros(len(keys), np.float32), self.order
        while len(left):
            if m == 0:
                at, there = self.find(slots(np.zeros(1, np.int64), lang, 0))
                out[left] = weight[left] + (self.logp[at] if there[0] else np.log(UNIFORM))
                break
            at, there = self.find(slots(keys[left] & ((1 << (SYMBOL_BITS * m)) - 1), lang, m))
            out[left] = weight[left] + self.logp[at]
            left, m = left[~there], m - 1
            if len(left) and m:
                at, there = self.find(slots((keys[left] >> SYMBOL_BITS) & ((1 << (SYMBOL_BITS * m)) - 1), lang, m))
                weight[left] += np.where(there, self.logb[at], 0)
        return out

    def entropies(self, texts: list[str], lang: str) -> tuple[np.ndarray, np.ndarray]:
        """Mean negative log probability of each text's symbols and end mark (nats), and their number."""
        codes, lengths = symbols(texts, self.order)
        every = np.concatenate([self.log_probabilities(k, lang) for k in grams(codes, self.order)]).astype(np.float64)
        return -np.add.reduceat(every, np.cumsum(lengths) - lengths) / lengths, lengths


def train(docs: DataFrame, lang: str = "lang", text: str = "text", order: int = ORDER) -> Model:
    """A model of all rows, for each language. The driver holds the model's arrays, an entry of 16 bytes for each distinct n-gram."""

    @F.arrow_udf("long")
    def slot(langs: pa.Array, orders: pa.Array, keys: pa.Array) -> pa.Array:
        key, kind, out = keys.to_numpy(), orders.to_numpy(), np.zeros(len(keys), np.int64)
        names = np.array(langs.to_pylist(), dtype=object)
        for name in set(names.tolist()):
            for m in np.unique(kind):
                own = (names == name) & (kind == m)
                out[own] = slots(key[own], name, int(m)).view(np.int64)
        return pa.array(out)

    arrays = entries(counts(docs, lang, text, order), order).select(slot("lang", "order", "gram").alias("slot"), F.col("logp").cast("float"), F.col("logb").cast("float"))
    got = arrays.toArrow()
    found = got.column("slot").to_numpy().view(np.uint64)
    rank = np.argsort(found)
    return Model(found[rank], got.column("logp").to_numpy()[rank], got.column("logb").to_numpy()[rank], order)
