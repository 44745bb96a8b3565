"""Language identification by the nearest of several centroids per language.

Texts are vectors of character n-grams, hashed to a fixed number of dimensions, weighted by TF-IDF and of length one. The
inverse document frequencies come from all rows that labels may be learned from. For each language a bounded sample of its
rows is clustered by spherical k-means, and a text takes the language of the centroid with the largest cosine; texts further
from it than its own sample is are marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import broadcast_if_small, held_out, settled, text_pair

#: Dimensions, sizes of n-grams, expected rows of a language's sample, clusters of a language, and rounds of clustering.
DIMENSIONS = 4096
SIZES = (1, 2, 3)
SAMPLE = 1000
CLUSTERS = 4
ROUNDS = 10
SHARPNESS = 20.0
#: How far below its sample's least cosine a centroid still accepts a text.
SLACK = 0.9
UNKNOWN = "und"
GROUP = 64

LETTER = regex.compile(r"\p{L}")


def frequencies(texts: list[str]) -> np.ndarray:
    """Counts of the n-grams within each text, one row of ``DIMENSIONS`` for a text."""
    plain = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(plain).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    rows = np.repeat(np.arange(len(texts)), [len(t) for t in plain])
    blank = (points < 128) & ((points < 97) | (points > 122))  # what isn't a letter in ASCII is one blank, however long
    kept = ~(blank & np.concatenate([[False], blank[:-1] & (rows[1:] == rows[:-1])]))
    points, rows = np.where(blank, 32, points).astype(np.uint64)[kept], rows[kept]
    counts, key = np.zeros(len(texts) * DIMENSIONS, np.int64), np.zeros(len(points), np.uint64)
    for n in range(1, max(SIZES) + 1):
        key = (key[: len(points) - n + 1] + points[n - 1 :] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        if n in SIZES:
            first = rows[: len(key)]
            whole = first == rows[n - 1 :]
            counts += np.bincount((first * DIMENSIONS + (key >> np.uint64(52)).astype(np.int64))[whole], minlength=len(counts))
    return counts.reshape(len(texts), DIMENSIONS)


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    """TF-IDF vectors of length one."""
    v = np.log1p(frequencies(texts)).astype(np.float32) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _texts(column: pa.Array) -> Iterator[list[str]]:
    """The texts of a column, some at a time; null as the empty text."""
    for at in range(0, len(column), GROUP):
        yield [t or "" for t in column.slice(at, GROUP).to_pylist()]


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros(DIMENSIONS, np.int64), 0
    for batch in batches:
        for texts in _texts(batch.column(0)):
            total += (frequencies(texts) > 0).sum(axis=0)
            rows += len(texts)
    place = np.arange(-1, DIMENSIONS, dtype=np.int32)  # at -1 the rows themselves
    yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(np.append(rows, total))], ["place", "n"])


def cluster(v: np.ndarray, k: int = CLUSTERS, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means; the first centre is the mean, and each further one the row that is furthest from all centres."""
    centres = v.mean(axis=0, keepdims=True)
    centres /= max(float(np.linalg.norm(centres)), 1e-12)
    while len(centres) < min(k, len(v)):
        centres = np.vstack([centres, v[np.argmin((v @ centres.T).max(axis=1))]])
    for _ in range(rounds):
        own = (v @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            if (own == c).any():
                m = v[own == c].mean(axis=0)
                centres[c] = m / max(float(np.linalg.norm(m)), 1e-12)
    return centres


class Centroids:
    """Centroids with their languages, and the least cosine with which a text isn't rejected."""

    def __init__(self, langs: list[str], centres: np.ndarray, least: np.ndarray, idf: np.ndarray):
        self.langs, self.centres, self.least, self.idf = langs, centres, least, idf
        self.names = sorted(set(langs))
        self.group = np.array([self.names.index(x) for x in langs], np.int64)

    def predict(self, texts: list[str]) -> list[tuple[str, float, float, bool]]:
        """Language, score, distance, and whether it is too far, of each text."""
        if not self.names:
            return [(UNKNOWN, 0.0, 1.0, True)] * len(texts)
        cosine = vectors(texts, self.idf) @ self.centres.T
        by_lang = np.full((len(texts), len(self.names)), -1.0)
        for c, g in enumerate(self.group):
            by_lang[:, g] = np.maximum(by_lang[:, g], cosine[:, c])
        best, nearest = by_lang.argmax(axis=1), cosine.argmax(axis=1)
        score = 1.0 / np.exp(SHARPNESS * (by_lang - by_lang.max(axis=1, keepdims=True))).sum(axis=1)
        out = []
        for i, t in enumerate(texts):
            if LETTER.search(t):
                top = float(np.clip(by_lang[i, best[i]], -1, 1))
                out.append((self.names[best[i]], float(score[i]), 1.0 - top, bool(top < self.least[nearest[i]])))
            else:
                out.append((UNKNOWN, 0.0, 1.0, True))
        return out


def train(docs: DataFrame, lang: str = "lang", text: str = "text", sample: int = SAMPLE, clusters: int = CLUSTERS) -> Centroids:
    """Centroids from all rows of ``docs`` that have a language.

    Document frequencies are of all these rows. Of each language, ``sample`` distinct texts are clustered (expected; a text is taken
    by its hash, or all texts where there are fewer), in one task for a language. A text counts once however often it is copied,
    so their number is bounded; the share to take of each language is sent to the readers, and only what is taken is moved. The driver gets the frequencies and the
    centroids, ``clusters`` for each language.
    """
    known = docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    found = known.select("text").mapInArrow(_document_frequencies, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(DIMENSIONS + 1, np.int64)
    df[found.column("place").to_numpy() + 1] = found.column("n").to_numpy()
    idf = (np.log((1 + df[0]) / (1 + df[1:])) + 1).astype(np.float32)
    keyed = known.select("lang", "text", *text_pair("text"))
    share = keyed.select("lang", "_h1", "_h2").distinct().groupBy("lang").agg((F.lit(float(sample)) / F.count("*")).alias("share"))
    place = F.shiftrightunsigned(F.xxhash64("text", F.lit(7)), 11) / F.lit(float(1 << 53))
    drawn = keyed.join(broadcast_if_small(settled(share)), "lang").where(place < F.col("share"))
    taken = drawn.groupBy("lang", "_h1", "_h2").agg(F.first("text").alias("text")).select("lang", "text")

    def fit(table: pa.Table) -> pa.Table:
        texts = sorted(t for t in table.column("text").to_pylist() if t and LETTER.search(t))
        name = table.column("lang")[0].as_py()
        schema = pa.schema([("lang", pa.string()), ("centre", pa.binary()), ("least", pa.float64())])
        if not texts:
            return schema.empty_table()
        v = np.vstack([vectors(texts[i : i + GROUP], idf) for i in range(0, len(texts), GROUP)])
        centres = cluster(v, clusters)
        cosine = v @ centres.T
        own = cosine.argmax(axis=1)
        least = [float(cosine[own == c, c].min()) * SLACK if (own == c).any() else 1.0 for c in range(len(centres))]
        return pa.table([[name] * len(centres), [c.astype(np.float32).tobytes() for c in centres], least], schema=schema)

    rows = taken.groupBy("lang").applyInArrow(fit, "lang string, centre binary, least double").collect()
    rows.sort(key=lambda r: (r.lang, bytes(r.centre)))
    centres = np.array([np.frombuffer(r.centre, np.float32) for r in rows], np.float32).reshape(-1, DIMENSIONS)
    return Centroids([r.lang for r in rows], centres, np.array([r.least for r in rows]), idf)


def language_of(model: Centroids, text: str | Column, spark) -> Column:
    """A struct (lang_pred, score, distance, rejected) of a text column; the model's size is fixed by the number of languages."""
    sent = spark.sparkContext.broadcast((model.langs, model.centres, model.least, model.idf))
    held: list[Centroids] = []

    @F.arrow_udf("lang_pred string, score double, distance double, rejected boolean")
    def of(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(Centroids(*sent.value))
        rows = [x for part in _texts(texts) for x in held[0].predict(part)]
        lang, score, distance, rejected = zip(*rows) if rows else ((), (), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(distance, pa.float64()), pa.array(rejected, pa.bool_())], names=["lang_pred", "score", "distance", "rejected"]
        )

    return of(text)


def op4(docs: DataFrame) -> DataFrame:
    """The language of every document, learned from those that aren't held out.

    Null texts and texts without a letter get ``und``, score 0; so does every text where no language can be learned. Other
    texts get the nearest language, however far; ``rejected`` says that it is too far. Rows without an id are learned from.
    """
    model = train(docs.where(~held_out()))
    return docs.select("doc_id", held_out().alias("held_out"), language_of(model, "text", docs.sparkSession).alias("p")).select("doc_id", "held_out", "p.*")
