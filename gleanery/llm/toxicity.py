"""Toxicity from the nearest labelled examples.

A bounded sample of the labelled rows gives the examples. Their terms (words, and beginnings of words) make the vocabulary, those
first that the labels depend on most; texts are TF-IDF vectors over it, in which a term weighs by that dependence as well. The examples stand in an inverted index cut into blocks, with the largest
weight of each term in each block. A search visits the blocks of the largest bounds that these maxima give, then those that can still
reach the examples found; lists of frequent terms have a place for each example, and the texts that visit a block are multiplied with
its lists at once. Examples in reach are summed up anew: the cosines and the nearest examples are exact. Votes weighted by nearness become a probability by
isotonic regression on votes of the examples themselves, each without its own.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import held_out, settled

#: Expected examples of label 1 and of label 0, terms, least examples of a term, power of its evidence (G2) in its weight, neighbours, block
#: size, blocks visited first, terms whose lists have a place for each example, texts searched at once and weight of no vote.
EXAMPLES = (1500, 6000)
TERMS = 8192
LEAST = 3
EVIDENCE_POWER = 0.5
NEIGHBOURS = 15
BLOCK = 64
STEP = 8
FREQUENT = 1024
TEXTS = 64
#: Words whose terms a task remembers.
KNOWN = 1 << 18
DOUBT = 0.5
THRESHOLD = 0.3
BEGINNINGS = (4, 5, 6)

_SPACED = bytes(i if i >= 128 or chr(i).isalnum() else 32 for i in range(256))


def word_counts(text: bytes) -> Counter:
    """Words in lower case: runs of ASCII letters and digits and of all other characters beyond ASCII."""
    return Counter(text.decode("utf-8", "replace").lower().encode().translate(_SPACED).split())


def terms(words: Counter) -> Counter:
    """Counts of the words (``=word``) and of the beginnings, in bytes, of longer words (``^begin``)."""
    out = Counter()
    for w, n in words.items():
        out[b"=" + w] += n
        for k in BEGINNINGS:
            if len(w) > k:
                out[b"^" + w[:k]] += n
    return out


class Index:
    """Examples as an inverted index in blocks; ``sizes`` and the arrays after it hold each example's terms and weights."""

    def __init__(self, vocabulary: list[bytes], idf: np.ndarray, ids: np.ndarray, labels: np.ndarray, sizes: np.ndarray, flat: np.ndarray, weights: np.ndarray, curve: tuple | None = None):
        self.parts = (vocabulary, idf, ids, labels, sizes, flat, weights)
        self.idf, self.ids, self.labels, self.curve = idf, ids, labels, curve
        self.words = {t[1:]: i for i, t in enumerate(vocabulary) if t[:1] == b"="}
        self.begins = {t[1:]: i for i, t in enumerate(vocabulary) if t[:1] == b"^"}
        self.short = {t[: BEGINNINGS[0]] for t in self.begins}
        self.known: dict[bytes, tuple[int, ...]] = {}
        self.blocks = max(1, -(-len(ids) // BLOCK))
        example = np.repeat(np.arange(len(ids)), sizes)
        self.flat, self.weights, self.sizes, self.own = flat, weights, sizes, np.cumsum(sizes) - sizes
        self.most = np.zeros((len(vocabulary), self.blocks), np.float32)
        np.maximum.at(self.most, (flat, example // BLOCK), weights)
        lengths = np.bincount(flat, minlength=len(vocabulary))
        frequent = np.argsort(-lengths, kind="stable")[:FREQUENT]
        self.column = np.full(len(vocabulary), -1)
        self.column[frequent] = np.arange(len(frequent))
        column = self.column[flat]
        dense, rare = column >= 0, np.flatnonzero(column < 0)
        self.lists = np.zeros((self.blocks, len(frequent), BLOCK), np.float32)
        self.lists[example[dense] // BLOCK, column[dense], example[dense] % BLOCK] = weights[dense]
        rare = rare[np.argsort(flat[rare], kind="stable")]
        self.example, self.weight = example[rare], weights[rare]
        self.starts = np.searchsorted(flat[rare], np.arange(len(vocabulary) + 1))
        self.at = np.full(len(vocabulary), -1)

    def terms_of(self, word: bytes) -> tuple[int, ...]:
        """Terms of the vocabulary that a word counts for."""
        own = [self.words.get(word)]
        if word[: BEGINNINGS[0]] in self.short:
            own += [self.begins.get(word[:k]) for k in BEGINNINGS if len(word) > k]
        return tuple(t for t in own if t is not None)

    def query(self, words: Counter) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights, of length one, of a text."""
        tf: dict[int, int] = {}
        known = self.known
        if len(known) > KNOWN:
            known.clear()
        for w, n in words.items():
            own = known.get(w)
            if own is None:
                known[w] = own = self.terms_of(w)
            for t in own:
                tf[t] = tf.get(t, 0) + n
        found = np.fromiter(tf, np.int64, len(tf))
        v = (1 + np.log(np.fromiter(tf.values(), np.float64, len(tf)))) * self.idf[found]
        return found, v / max(np.linalg.norm(v), 1e-12)

    def nearest(self, found: np.ndarray, v: np.ndarray, k: int = NEIGHBOURS, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The k examples with the largest cosine above zero, ties by place, and their cosines."""
        return self.search([(found, v)], k, [without])[0]

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBOURS, without: list[int | None] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """What ``nearest`` gives for each query."""
        if not len(self.ids):
            return [(np.zeros(0, np.int64), np.zeros(0))] * len(queries)
        weights = np.zeros((len(queries), self.lists.shape[1]), np.float32)
        score = np.zeros((len(queries), self.blocks * BLOCK), np.float32)
        bound = np.zeros((len(queries), self.blocks))
        for i, (found, v) in enumerate(queries):
            if not len(found):
                continue
            bound[i] = v @ self.most[found]
            column = self.column[found]
            weights[i, column[column >= 0]] = v[column >= 0]
            rare, first = column < 0, self.starts[found[column < 0]]
            post, size = _runs(first, self.starts[found[rare] + 1] - first)
            score[i] = np.bincount(self.example[post], self.weight[post] * np.repeat(v[rare], size), score.shape[1])
        # What single precision can be wrong by, on both sides of a comparison.
        slack = np.array([[(len(found) + 4) * 2.0**-22 + 1e-6] for found, _ in queries])
        out = np.array([self.ids == w for w in without]) if without and any(w is not None for w in without) else None

        def visit(blocks: np.ndarray) -> None:
            for b in np.flatnonzero(blocks.any(axis=0)):
                at = np.flatnonzero(blocks[:, b])
                score[at, b * BLOCK : (b + 1) * BLOCK] += weights[at] @ self.lists[b]

        def reached(blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            seen = np.where(np.repeat(blocks, BLOCK, axis=1), score, np.float32(0))
            if out is not None:
                seen[:, : len(self.ids)][out] = 0
            least = np.partition(seen, seen.shape[1] - k, axis=1)[:, [seen.shape[1] - k]] if seen.shape[1] >= k else np.zeros((len(seen), 1))
            return seen, least

        best = np.zeros(bound.shape, bool)
        np.put_along_axis(best, np.argsort(-bound, axis=1, kind="stable")[:, :STEP], True, axis=1)
        best &= bound > 0
        visit(best)
        more = (bound > np.maximum(reached(best)[1] - slack, 0)) & ~best
        visit(more)
        seen, least = reached(best | more)
        near = seen > np.maximum(least - slack, 0)
        return [self._exact(*query, np.flatnonzero(near[i]), k) for i, query in enumerate(queries)]

    def _exact(self, found: np.ndarray, v: np.ndarray, near: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest of some examples and their cosines, summed in the order of the query's terms."""
        post, size = _runs(self.own[near], self.sizes[near])
        self.at[found] = np.arange(len(found))
        at = self.at[self.flat[post]]
        self.at[found] = -1
        order = np.flatnonzero(at >= 0)
        order = order[np.argsort(at[order], kind="stable")]
        score = np.bincount(np.repeat(np.arange(len(near)), size)[order], self.weights[post[order]] * v[at[order]], len(near))
        top = np.lexsort((near, -np.round(score, 9)))[:k]
        return near[top], np.minimum(score[top], 1.0)

    def vote(self, best: np.ndarray, cosine: np.ndarray) -> float:
        """Share of label 1 among the neighbours, each weighted by its nearness, with some weight for no vote."""
        return float((cosine * self.labels[best]).sum() / (cosine.sum() + DOUBT))

    def score(self, vote: float) -> float:
        return float(np.interp(vote, *self.curve)) if self.curve else vote


def _runs(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of runs with these starts and sizes, one after another, and the sizes."""
    ends = np.cumsum(size)
    return np.arange(size.sum()) + np.repeat(first - (ends - size), size), size


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the non-decreasing curve through (x, y), pooled where y falls, drawn a little towards the overall mean."""
    mean = float((y * weight).sum() / weight.sum())
    pools: list[list[float]] = []
    for at in np.unique(x):
        own = x == at
        pools.append([at * weight[own].sum(), (y[own] * weight[own]).sum(), weight[own].sum()])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([p[0] / p[2] for p in pools]), np.array([(p[1] + mean) / (p[2] + 1) for p in pools])


def _raw(value: pa.Scalar) -> bytes:
    return value.as_buffer().to_pybytes() if value.is_valid else b""


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text", examples: tuple[int, int] = EXAMPLES) -> Index:
    """An index of labelled rows.

    ``labels`` has ids with a label of 0 or 1; other labels and null ids are left out, of repeated ids the larger label holds.
    Of label 1 and label 0 as many rows as ``examples`` says are taken (expected, by a hash of the id; all where there are
    fewer), so their number is bounded, and so is all that the driver and the workers hold of them. Rates are corrected for the sampling.
    """
    given = settled(labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(F.max(label).cast("int").alias("label")))
    share = {r.label: min(1.0, examples[1 - r.label] / r["count"]) for r in given.groupBy("label").count().collect()}
    place = F.shiftrightunsigned(F.xxhash64("id", F.lit(3)), 11) / F.lit(float(1 << 53))
    taken = F.broadcast(given.where(place < F.when(F.col("label") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0))))
    sample = settled(docs.join(taken, docs[doc_id] == taken["id"]).select("id", "label", F.col(text).alias("text")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [Counter(), Counter()]
        for batch in batches:
            for y, t in zip(batch.column(1).to_pylist(), batch.column(2)):
                seen[y].update(terms(word_counts(_raw(t))).keys())
        for y in (0, 1):
            if seen[y]:
                yield pa.RecordBatch.from_arrays([pa.array(list(seen[y]), pa.binary()), pa.array([y] * len(seen[y]), pa.int32()), pa.array(list(seen[y].values()), pa.int64())], ["term", "label", "n"])

    rows = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    n1, n0 = float(rows.get(1, 0)), float(rows.get(0, 0))
    n = max(n1 + n0, 1.0)
    a, b = F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)), F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0))
    both = sample.mapInArrow(count, "term binary, label int, n long").groupBy("term").agg(a.alias("a"), b.alias("b")).where(f"a + b >= {LEAST}")
    part = lambda o, e: F.when(o > 0, o * F.log(o / F.greatest(e, F.lit(1e-12)))).otherwise(0.0)
    a, b, r = F.col("a"), F.col("b"), F.col("a") + F.col("b")
    g2 = 2 * (part(a, r * n1 / n) + part(b, r * n0 / n) + part(n1 - a, (n - r) * n1 / n) + part(n0 - b, (n - r) * n0 / n))
    chosen = both.withColumn("g2", g2).where("g2 > 0").orderBy(F.desc("g2"), "term").limit(TERMS).collect()
    vocabulary = [bytes(r.term) for r in chosen]
    idf = np.array([(np.log((1 + n) / (1 + r.a + r.b)) + 1) * r.g2**EVIDENCE_POWER for r in chosen])
    empty = Index(vocabulary, idf, np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))

    def vector(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [empty.query(word_counts(_raw(t))) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([f.tolist() for f, _ in got], pa.list_(pa.int64())), pa.array([v.tolist() for _, v in got], pa.list_(pa.float64()))], ["id", "label", "terms", "v"])

    kept = sample.mapInArrow(vector, "id long, label int, terms array<long>, v array<double>").collect()
    # Examples that share their heaviest term stand together, so that blocks differ in what they hold.
    kept.sort(key=lambda r: (r.terms[int(np.argmax(r.v))] if r.terms else -1, len(r.terms), r.id))
    join = lambda xs, kind: np.array([y for x in xs for y in x], kind)
    index = Index(
        vocabulary, idf, np.array([r.id for r in kept], np.int64), np.array([r.label for r in kept], np.float64),
        np.array([len(r.terms) for r in kept], np.int64), join([r.terms for r in kept], np.int64), join([r.v for r in kept], np.float64),
    )
    parts = index.parts

    def own_votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Index(*parts)
        for batch in batches:
            ids, votes = batch.column(0).to_pylist(), []
            for at in range(0, len(ids), TEXTS):
                queries = [own.query(word_counts(_raw(t))) for t in batch.column(2).slice(at, TEXTS)]
                votes += [own.vote(*found) for found in own.search(queries, without=ids[at : at + TEXTS])]
            yield pa.RecordBatch.from_arrays([pa.array(votes, pa.float64()), batch.column(1)], ["vote", "label"])

    votes = sample.mapInArrow(own_votes, "vote double, label int").collect()
    if votes:
        y = np.array([r.label for r in votes], np.float64)
        index.curve = isotonic(np.array([r.vote for r in votes]), y, 1 / np.where(y == 1, share.get(1, 1.0), share.get(0, 1.0)))
    return index


def toxicity_of(index: Index, text: str | Column, spark) -> Column:
    """A struct (score, evidence) of a text column; evidence has the ids of the nearest examples with label 1."""
    sent = spark.sparkContext.broadcast((index.parts, index.curve))
    held: list[Index] = []

    @F.arrow_udf("score double, evidence array<long>")
    def of(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(Index(*sent.value[0], sent.value[1]))
        own, scores, evidence = held[0], [], []
        for at in range(0, len(texts), TEXTS):
            for best, cosine in own.search([own.query(word_counts(_raw(t))) for t in texts.slice(at, TEXTS)]):
                scores.append(min(1.0, max(0.0, own.score(own.vote(best, cosine)))))
                evidence.append(own.ids[best[own.labels[best] == 1][:3]].tolist())
        return pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(evidence, pa.list_(pa.int64()))], names=["score", "evidence"])

    return of(text)


def op1(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The toxicity of every document, learned from labels of those that aren't held out.

    Null texts are empty texts; texts without a term of the vocabulary get the rate of such examples. Without labels every
    score is 0. Rows without an id are scored as well; repeated rows get equal scores.
    """
    index = train(docs.where(~held_out()), labels.where(~held_out()))
    scored = docs.select("doc_id", held_out().alias("held_out"), toxicity_of(index, "text", docs.sparkSession).alias("p"))
    return scored.select("doc_id", "held_out", F.col("p.score").alias("score"), (F.col("p.score") >= THRESHOLD).cast("int").alias("predicted"), F.col("p.evidence").alias("evidence"))
