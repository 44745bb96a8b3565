"""The pipeline, stage by stage, against plain versions."""

import sys
from collections import Counter
from pathlib import Path

import corpus_pipeline
from gleanery.llm import quality
from gleanery.llm.queries import tokenizer_path

sys.path.insert(0, str(Path(__file__).resolve().parent))
import plain  # noqa: E402


def test_stages(spark, sf, tmp_path):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    made = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        made.append(docs)
    start = spark.read.parquet(f"{sf}/documents.parquet")
    good, single, apart, mixed, done = made
    assert all(d.columns == start.columns for d in made[:4])
    ids = lambda d: sorted(r.doc_id for r in d.select("doc_id").collect())
    pairs = lambda d: [(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()]
    assert ids(good) == ids(quality.op2(start).where("kept"))
    assert ids(single) == sorted({keep for _, keep, *_ in plain.exact(pairs(good))})
    assert ids(apart) == sorted({c for _, _, c in plain.near(pairs(single))})
    size, most, source = Counter(), Counter(), {}
    for r in apart.collect():
        n = len(plain.WORD.findall(r.text or ""))
        size[r.source] += n
        most[r.source] = max(most[r.source], n)
        source[r.doc_id] = r.source
    got = Counter()
    for r in mixed.collect():
        got[source[r.doc_id]] += len(plain.WORD.findall(r.text or ""))
    for s, target in plain.targets(dict(size)).items():
        assert abs(got[s] - target) <= 0.5 * most[s] + 1
    known = Tokenizer.from_file(tokenizer_path())
    expected = sorted((i, *plain.tokens(known, t)[::2]) for i, t in pairs(mixed))
    assert sorted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in done.collect()) == expected


def test_run_on_no_rows(spark, sf, tmp_path):
    spark.read.parquet(f"{sf}/documents.parquet").where("false").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_dedup_sends_texts_in_small_batches(spark, monkeypatch):
    """While exact and near dedup read texts, Python gets few rows at once; the session's own setting is back afterwards."""
    from gleanery.llm import common, exact, simhash

    setting, docs = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.createDataFrame([(i, f"text {i % 3}") for i in range(9)], "doc_id long, text string")
    before = spark.conf.get(setting, None)
    for module, dedup in ((exact, exact.exact_dedup), (simhash, simhash.near_dedup)):
        seen, settled = [], module.settled
        monkeypatch.setattr(module, "settled", lambda df: (seen.append(spark.conf.get(setting)), settled(df))[1])
        assert dedup(docs).count() >= 1
        assert str(common.TEXT_ROWS) in seen
    assert spark.conf.get(setting, None) == before


def test_blocks_are_rebuilt_in_small_pieces(spark, monkeypatch):
    """Blocks of the last stage are small beside an executor's memory, and so is what is written of a block at once."""
    import numpy as np

    from gleanery.llm import bpe
    from gleanery.llm.packing import pack

    asked = {}
    monkeypatch.setattr(corpus_pipeline, "encode", lambda docs, path, **given: (asked.update(given), bpe.encode(docs, path, **given))[1])
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(5)], "doc_id long, text string")
    assert corpus_pipeline.token_ids(spark, docs, "").count() == 5
    assert asked["block_bytes"] <= 8 << 20
    n, each = 5, 400_000
    place = pack(np.arange(n), np.full(n, each), np.zeros(1, np.int64), np.zeros(n * each, np.int64))
    answer = pack(np.array([1]), np.array([0]))
    made = list(bpe._rebuilt(iter([bpe._batch([(0, bpe.DOCUMENTS, place), (0, 0, answer)])]), [b"x"], bpe._as_tokens))
    assert [r for b in made for r in b.column(0).to_pylist()] == list(range(n))
    assert all(len(ids) == each for b in made for ids in b.column(1))
    assert max(b.num_rows for b in made) * 4 * each < 4_000_000


def test_dedup_takes_one_python_worker_for_a_task(spark, monkeypatch):
    """No stage of exact and near dedup runs Python twice in a task: workers live on, and count in the memory of all later stages."""
    from gleanery.llm import exact, simhash

    docs = spark.createDataFrame([(i, f"some text {i % 3}") for i in range(9)], "doc_id long, text string")
    plans = []
    for module, dedup in ((exact, exact.exact_dedup), (simhash, simhash.near_dedup)):
        settled = module.settled
        monkeypatch.setattr(module, "settled", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), settled(df))[1])
        plans.append(dedup(docs)._jdf.queryExecution().executedPlan().toString())
    stages = [s for p in plans for s in p.split("Exchange")]
    python = [s.count("MapInArrow") + s.count("EvalPython") for s in stages]
    assert max(python) == 1


def test_merged_copies_go_to_the_bucket_of_their_key():
    import numpy as np
    import pyarrow as pa

    from gleanery.llm import exact

    keys = [-(1 << 63), -5, 0, 7, (1 << 62) + 1, (1 << 63) - 1]  # in the order that Spark sorts them
    starts = np.array([0, 1 << 62, 1 << 63, (1 << 64) - 5], np.uint64)
    rows = pa.RecordBatch.from_arrays([pa.array(keys + keys[-1:]), pa.array([b"x"] * 7), pa.array(range(7)), pa.array([1] * 7)], ["key", "bytes", "doc_id", "n"])
    made = [r for b in exact._merged(iter([rows]), starts) for r in b.to_pylist()]
    assert [(r["key"], r["bucket"], r["n"]) for r in made] == list(zip(keys, [2, 3, 0, 0, 1, 1], [1, 1, 1, 1, 1, 2]))
