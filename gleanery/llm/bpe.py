"""BPE encoding and decoding through a table of distinct words.

Texts are split into words at ASCII white space, which no piece of the tokenizer crosses. A block of documents is kept as the
table of its distinct words and, for every document, the places of its words in that table. The words of all blocks meet by
hash: the task that owns a word encodes it once, whichever blocks it stands in, and answers each block with ids. A block then
puts the ids back by position. Pieces are found by id in the tokenizer's own table, whose size is fixed.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import release_memory
from gleanery.llm.packing import pack, unpack

#: Text bytes of a block, and hash parts of the word table.
BLOCK_BYTES = 32 << 20
PARTS = 1024
STEP = 1 << 20
#: Rows read out of a batch at a time, and bytes of ids in a batch of results.
ROWS = 64
OUT_BYTES = 1 << 20
DOCUMENTS = -1
#: Stands for the id of rows without one.
NO_ID = -(1 << 63)

BLOCK = "block long, part int, payload binary"


class Numbers(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    block, part, payload = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array(part, pa.int32()), pa.array(payload, pa.binary())], ["block", "part", "payload"])


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Blocks of (row id, text): one row with the documents' word places, and one row of words for each part."""
    release_memory()  # of tasks before
    task = TaskContext.get().partitionId() << 32
    ids, codes, lengths, numbers, size, done = [], [], [], Numbers(), 0, 0

    def close() -> Iterator[pa.RecordBatch]:
        every = np.concatenate(codes) if codes else np.empty(0, np.int32)
        codes.clear()
        often = np.zeros(len(numbers), np.int64)
        for at in range(0, len(every), STEP):
            often += np.bincount(every[at : at + STEP], minlength=len(numbers))
        order = np.argsort(-often, kind="stable")  # frequent words get small numbers
        renamed = np.empty(len(order), np.int32)
        renamed[order] = np.arange(len(order), dtype=np.int32)
        spelled = list(numbers)
        spelled = [spelled[i] for i in order.tolist()]
        part = np.fromiter((zlib.crc32(w) % parts for w in spelled), np.int64, len(spelled))
        yield _batch([(task + done, DOCUMENTS, pack(np.array(ids, np.int64), np.array(lengths, np.int64), part, renamed[every]))])
        owned: list[list[bytes]] = [[] for _ in range(parts)]
        for w, p in zip(spelled, part.tolist()):
            owned[p].append(w)
        yield _batch([(task + done, p, zstandard.compress(b"\n".join(ws), 3)) for p, ws in enumerate(owned) if ws] or [(task + done, 0, b"")])

    for batch in batches:
        for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = text.as_buffer().to_pybytes().split() if text.is_valid else []
            codes.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
            ids.append(row)
            lengths.append(len(found))
            size += len(text.as_buffer()) if text.is_valid else 0
            if size >= block_bytes:
                yield from close()
                ids, codes, lengths, numbers, size, done = [], [], [], Numbers(), 0, done + 1
    if ids:
        yield from close()
    release_memory()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of batches, of which only a few are copied out of Arrow's memory at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, ROWS).columns))


def _groups(batches: Iterator[pa.RecordBatch], by: int) -> Iterator[list[tuple]]:
    """Rows with one value in column ``by``, from rows sorted by it."""
    rows: list[tuple] = []
    for row in _rows(batches):
        if rows and rows[-1][by] != row[by]:
            yield rows
            rows = []
        rows.append(row)
        if row[1] == DOCUMENTS and by == 1:  # goes through alone
            yield rows
            rows = []
    if rows:
        yield rows


def _encoded(batches: Iterator[pa.RecordBatch], tokenizer_json: str) -> Iterator[pa.RecordBatch]:
    """The ids of the words asked for; each distinct word of a part is encoded once."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    release_memory()  # of tasks before
    tokenizer = Tokenizer.from_str(tokenizer_json)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    for rows in _groups(batches, 1):
        if rows[0][1] == DOCUMENTS:
            yield _batch(rows)
            continue
        asked = [zstandard.decompress(p).split(b"\n") if p else [] for _, _, p in rows]
        table = dict.fromkeys(w for ws in asked for w in ws)
        spelled = list(table)
        for at in range(0, len(spelled), 4096):
            part = spelled[at : at + 4096]
            for w, e in zip(part, tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in part], add_special_tokens=False)):
                table[w] = e.ids
        for (block, part, _), ws in zip(rows, asked):
            got = [table[w] for w in ws]
            yield _batch([(block, part, pack(np.fromiter(map(len, got), np.int64, len(got)), np.fromiter((i for g in got for i in g), np.int64)))])
        rows.clear()
    del tokenizer
    release_memory()


def _rebuilt(batches: Iterator[pa.RecordBatch], pieces: list[bytes], emit: Callable) -> Iterator[pa.RecordBatch]:
    """Documents of each block from their word places and the answers of all parts."""
    release_memory()  # of tasks before
    for rows in _groups(batches, 0):
        ids, lengths, part, codes = unpack(next(p for _, n, p in rows if n == DOCUMENTS))
        codes = codes.astype(np.int32)
        answers = [unpack(p) for _, n, p in sorted((r for r in rows if r[1] != DOCUMENTS), key=lambda r: r[1])]
        rows.clear()
        sizes = np.concatenate([a[0] for a in answers]) if answers else np.empty(0, np.int64)
        flat = np.concatenate([a[1] for a in answers]) if answers else np.empty(0, np.int64)
        ends = np.cumsum(sizes)
        raw, spelled = flat.astype("<u4").tobytes(), [pieces[i] for i in flat.tolist()]
        word_ids: list[bytes] = [b""] * len(part)
        word_text: list[bytes | None] = [None] * len(part)
        for place, start, end in zip(np.argsort(part, kind="stable").tolist(), (ends - sizes).tolist(), ends.tolist()):
            word_ids[place] = raw[4 * start : 4 * end]
            word_text[place] = b" ".join(spelled[start:end]) if end > start else None
        del answers, sizes, flat, ends, raw, spelled, part
        whole = None not in word_text
        at, out, size = 0, [], 0
        for row, n in zip(ids.tolist(), lengths.tolist()):
            own = codes[at : at + n].tolist()
            at += n
            texts = map(word_text.__getitem__, own)
            out.append((row, b"".join(map(word_ids.__getitem__, own)), b" ".join(texts if whole else (t for t in texts if t is not None))))
            size += len(out[-1][1])
            if size > OUT_BYTES:
                yield emit(out)
                out, size = [], 0
        if out:
            yield emit(out)
        del ids, lengths, codes, word_ids, word_text, out
        release_memory()
    release_memory()  # the last rows read are free only now


def _as_digests(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([len(r[1]) // 4 for r in rows], pa.int64()), pa.array([sha(r[1]) for r in rows]), pa.array([sha(r[2]) for r in rows])],
        ["row", "n_tokens", "ids_sha256", "decoded_sha256"],
    )


def _as_tokens(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    lists = pa.ListArray.from_arrays(np.cumsum([0] + [len(r[1]) // 4 for r in rows]).astype(np.int32), pa.array(np.frombuffer(b"".join(r[1] for r in rows), "<i4")))
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), lists, pa.array([r[2].decode() for r in rows])], ["row", "ids", "decoded"])


FORMS = {
    "digests": (_as_digests, "row long, n_tokens long, ids_sha256 string, decoded_sha256 string"),
    "tokens": (_as_tokens, "row long, ids array<int>, decoded string"),
}


def encode(docs: DataFrame, tokenizer: str, row: str = "doc_id", text: str = "text", form: str = "tokens", block_bytes: int = BLOCK_BYTES, parts: int = PARTS) -> DataFrame:
    """A row per row of ``docs``: ``row`` (its id, a long) with its ids and the text decoded from them, or with digests of both.

    ``tokenizer`` is the path of a file of the tokenizers library, read on the driver; special tokens aren't added. Null texts
    are empty texts and have no ids; rows without an id come back without one. Repeated ids come back as often as they are there.
    An empty table gives an empty table; other columns aren't read. A document is whole within one block, so a block is as
    large as the longest text at least.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    from tokenizers import Tokenizer

    known = Tokenizer.from_str(spec)
    if json.loads(spec).get("decoder") is not None:
        raise ValueError("only tokenizers without a decoder, whose pieces are joined by spaces")
    pieces = [(known.id_to_token(i) or "").encode() for i in range(known.get_vocab_size(with_added_tokens=True))]
    emit, schema = FORMS[form]
    narrow = docs.select(F.coalesce(F.col(row).cast("long"), F.lit(NO_ID)).alias("row"), F.col(text).alias("text"))
    blocks = narrow.mapInArrow(lambda b: _blocks(b, block_bytes, parts), BLOCK)
    spread = F.when(F.col("part") == DOCUMENTS, F.col("block")).otherwise(0)
    # The rows with the documents' word places only pass through the tasks that encode, so the texts are split just once.
    answered = blocks.repartition("part", spread).sortWithinPartitions("part").mapInArrow(lambda b: _encoded(b, spec), BLOCK)
    both = answered.repartition("block").sortWithinPartitions("block")
    return both.mapInArrow(lambda b: _rebuilt(b, pieces, emit), schema).withColumn("row", F.nullif("row", F.lit(NO_ID)))


def op8(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them."""
    return encode(docs, tokenizer, form="digests").select(F.col("row").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")
