"""Every operator on awkward rows, on no rows, and against a plain version."""

import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gleanery.llm import bpe, exact, extraction, language, lines, mixing, ngrams, quality, sharding, simhash, toxicity
from gleanery.llm.queries import tokenizer_path

sys.path.insert(0, str(Path(__file__).resolve().parent))
import plain  # noqa: E402

SCHEMA = "doc_id long, url string, lang string, source string, text string, row string, code int, size int, key string, `a.b` int"
LONG = " ".join(f"word{i % 997} and {i}," for i in range(40_000))
PROSE = "The river ran past the old mill, and nobody in the village could say who had built it or when the wheel last turned. " * 1

ROWS = [
    (0, "http://a/0", "en", "web", PROSE, "x", 1, 2, "k", 5),
    (1, "http://a/1", "en", "web", PROSE.replace(" ", "\t\n", 3), "x", 1, 2, "k", 5),
    (2, "http://a/2", "en", "web", "", None, None, None, None, None),
    (3, None, None, None, None, None, None, None, None, None),
    (4, "http://a/4", "de", "books", LONG, "x", 1, 2, "k", 5),
    (5, "http://a/5", "de", "books", "  \t\n\x0b\x0c\r ", "x", 1, 2, "k", 5),
    (6, "http://a/6", "fr", "", "Ünïcödé   naïve 😀   fin", "x", 1, 2, "k", 5),
    (7, "http://a/7", "fr", "", "1234 5678 !!! ###", "x", 1, 2, "k", 5),
    (8, "http://b/8", "en", "web", PROSE, "x", 1, 2, "k", 5),
    (8, "http://b/8", "en", "web", PROSE, "x", 1, 2, "k", 5),
    (-1, "http://b/9", "en", "code", "a\x00b [UNK] <s> </s>  two", "x", 1, 2, "k", 5),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def given(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def same(df, names, expected):
    assert rows(df, *names) == sorted(map(tuple, expected), key=repr)


# 2


def test_quality_counts(docs, given):
    for table in (docs, given):
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        found = quality.op2(table)
        expected = [(i, *plain.base_counts(t)) for i, t in pairs(table)]
        same(found, ["doc_id", *names], expected)
        failed = {i for i, n, _, _, _, r in expected if n < 50 or 100 * r > 50 * n}
        assert {r.doc_id for r in found.where("base_failed").collect()} == failed
        assert not found.where("base_failed and kept").count()


def test_quality_of_no_rows(none):
    assert quality.op2(none).count() == 0
    assert quality.quality_filter(none).columns == none.columns


def test_quality_bands_reject_shuffled_letters(spark, given):
    good = [r.text for r in given.where("lang = 'en' and length(text) > 600").limit(60).collect()]
    noise = "".join("qxzvkjw "[(i * i * 7 + i * 3) % 8] for i in range(900))
    table = spark.createDataFrame([(i, "en", t) for i, t in enumerate(good)] + [(10_000, "en", noise)], "doc_id long, lang string, text string")
    found = {r.doc_id: r for r in quality.quality(table).collect()}
    # A text of its own weighs in the model as well, so what counts is its place among the others.
    assert not found[10_000].kept
    assert sum(r.kept for i, r in found.items() if i < 10_000) >= 0.7 * len(good)


@pytest.mark.parametrize("share", [0.33, 0.5, 0.8])
def test_copies_change_no_other_verdict(spark, given, share):
    """A group of copies that holds a good part of all rows weighs as one text in the model and in the bands."""
    some = given.where("lang IN ('en', 'de')").limit(120).select("doc_id", "lang", "text").collect()
    table = spark.createDataFrame(some, "doc_id long, lang string, text string")
    text = next(r.text for r in some if r.lang == "en" and len(r.text or "") > 500)
    copies = spark.range(int(len(some) * share / (1 - share))).select((F.col("id") + 10**6).alias("doc_id"), F.lit("en").alias("lang"), F.lit(text).alias("text"))
    verdicts = lambda df: {r.doc_id: (r.kept, round(r.perplexity, 9), round(r.upper, 9)) for r in quality.quality(df).collect() if r.doc_id < 10**6}
    assert verdicts(table.unionByName(copies)) == verdicts(table)
    kept = {r.doc_id for r in quality.quality_filter(table.unionByName(copies)).collect()}
    assert {i for i in kept if i < 10**6} == {i for i, v in verdicts(table).items() if v[0]}


def test_filter_keeps_what_quality_keeps(docs, given):
    for table in (docs, given):
        kept = sorted(r.doc_id for r in quality.quality(table).where("kept").collect())
        assert sorted(r.doc_id for r in quality.quality_filter(table).collect()) == kept


def test_model_gives_distributions(spark):
    """The chances of all symbols but the begin mark, which is never predicted, sum to 1 after every context of the highest order."""
    import numpy as np

    table = spark.createDataFrame([("x", "abracadabra abacus cadabra"), ("x", "abraham a bar")], "lang string, text string")
    known = {(r.order, r.gram): (r.logp, r.logb) for r in ngrams.entries(ngrams.counts(table, "lang", "text")).collect()}
    bits = ngrams.SYMBOL_BITS

    def chance(gram, m):
        if (m, gram) in known:
            return np.exp(known[m, gram][0])
        return np.exp(known.get((m - 1, gram >> bits), (0, 0))[1] if m > 1 else 0) * chance(gram & ((1 << bits * (m - 1)) - 1), m - 1)

    contexts = {gram >> bits for m, gram in known if m == ngrams.ORDER}
    for context in contexts:
        assert abs(sum(chance(context << bits | last, ngrams.ORDER) for last in range(1 << bits) if last != ngrams.BEGIN) - 1) <= ngrams.UNIFORM + 1e-6


def test_model_misses_what_it_has_not_seen(spark):
    """Every n-gram has a hash of its own, and n-grams that weren't counted aren't found."""
    import numpy as np

    table = spark.createDataFrame([("x", "abracadabra abacus cadabra"), ("y", "abraham a bar")], "lang string, text string")
    model = ngrams.train(table)
    assert len(model) == ngrams.entries(ngrams.counts(table, "lang", "text")).count()
    keys = np.random.default_rng(1).integers(1 << 50, 1 << 60, 2_000_000)
    assert not model.find(ngrams.slots(keys, "x", ngrams.ORDER))[1].any()


# 3


def test_mix(docs, given):
    for table in (docs, given):
        read = table.select("doc_id", "source", "text").collect()
        size = Counter()
        for r in read:
            size[r.source] += len(plain.WORD.findall(r.text or ""))
        target = plain.targets(dict(size))
        source = {r.doc_id: r.source for r in read}
        taken = Counter()
        found = mixing.op3(table).collect()
        assert len(found) == len(read)
        for r in found:
            s = source[r.doc_id]
            assert r.source_size == size[s] and abs(r.target - target[s]) <= 1e-6 * max(1, target[s])
            assert 0 <= r.taken <= 3 * r.size
            taken[s] += r.taken
        assert all(abs(taken[s] - target[s]) <= 0.5 + 1e-6 for s in size)
        assert rows(mixing.op3(table), "doc_id", "taken") == rows(mixing.op3(table.repartition(7)), "doc_id", "taken")


def test_mixed_rows_keep_columns(docs, none):
    from gleanery.llm.common import words

    found = mixing.mixed_rows(docs, words("text"))
    assert found.columns == docs.columns and found.count() > 0
    assert mixing.op3(none).count() == 0
    assert mixing.mixed_rows(none, words("text")).count() == 0


def test_mixed_rows_are_what_the_mix_takes(given):
    from gleanery.llm.common import words

    taken = {r.doc_id: r for r in mixing.mix(given, words("text")).select("doc_id", "mix_size", "mix_taken").collect()}
    got = Counter(r.doc_id for r in mixing.mixed_rows(given, words("text")).select("doc_id").collect())
    assert {i: got[i] for i in taken} == {i: round(r.mix_taken / r.mix_size) if r.mix_size else 0 for i, r in taken.items()}


@pytest.mark.parametrize("seed", range(4))
def test_mixed_rows_of_repeated_rows(spark, seed):
    """A cut that lies among equal rows takes as many of them as the budget has room for."""
    from gleanery.llm.common import words

    rows = [(7, "a", "one two three")] * 300 + [(i, "a", "x " * (i % 9)) for i in range(200)] + [(None, None, "y y")] * 50 + [(i, "b", "w w w w") for i in range(90)] + [(1, "c", "")] * 5
    table = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got, sizes = Counter(), Counter()
    for r in mixing.mixed_rows(table, words("text"), seed=seed).collect():
        got[r.source] += len(r.text.split())
    for _, source, text in rows:
        sizes[source] += len(text.split())
    for source, target in plain.targets(dict(sizes)).items():
        assert abs(got[source] - target) <= 8


# 6


def test_exact(docs, given):
    names = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    for table in (docs, given):
        same(exact.op6(table), names, plain.exact(pairs(table)))


def test_exact_dedup_keeps_one_row(docs, none, spark):
    found = exact.exact_dedup(docs)
    assert found.columns == docs.columns
    assert sorted(r.doc_id for r in found.collect()) == sorted({keep for _, keep, *_ in plain.exact(pairs(docs))})
    assert exact.op6(none).count() == 0
    unnamed = spark.createDataFrame([(None, "a b"), (None, "a  b"), (5, "a b"), (None, "c")], "doc_id long, text string")
    assert sorted(r.doc_id or -9 for r in exact.exact_dedup(unnamed).collect()) == [-9, 5]


def test_exact_in_small_buckets(given):
    """A directory that has to double and split gives the same groups."""
    names = ["doc_id", "keep_id", "group_size"]
    assert rows(exact.exact_classes(given, room=3), *names) == rows(exact.exact_classes(given), *names)


# 7


def test_shards(docs, given, none):
    import zlib

    for table in (docs, given):
        found = sharding.op7(table).collect()
        assert len(found) == table.count()
        count = Counter(r.shard for r in found)
        assert max(count.values()) - min(count.get(s, 0) for s in range(24)) <= 1
        for s in count:
            assert sorted(r.slot for r in found if r.shard == s) == list(range(count[s]))
        text = dict(pairs(table))
        for r in found:
            data = (text[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)
    assert sharding.op7(none).count() == 0


def test_shards_keep_clashing_columns(spark):
    names = ["_arc", "_sub", "_salt", "_r", "_to", "_base", "key", "doc_id"]
    table = spark.createDataFrame([(i, -i, 77, i % 3, 5, 6, i * 7919 % 101, i) for i in range(300)], ", ".join(f"{n} long" for n in names))
    found = sharding.shard(table)
    assert rows(found, *names) == rows(table, *names) and found.columns == [*names, "shard", "slot"]


def test_one_more_shard_moves_few_rows(spark):
    """Overflow goes on clockwise, so a further shard leaves most rows where they are; dealing by remainder would move 24 of 25."""
    table = spark.range(20_000).select(F.col("id").alias("doc_id"), F.xxhash64("id").alias("key"))
    before, after = ({r.doc_id: r.shard for r in sharding.shard(table, shards=n).collect()} for n in (24, 25))
    moved = sum(before[i] != after[i] for i in before) / len(before)
    assert 1 / 25 <= moved + 0.01 and moved <= 0.5


def test_flows_keep_bounds():
    loads = [7, 0, 90, 1, 2, 0]
    parts = sharding.flows(loads, [0, 1, 2, 0, 1, 2], 3)
    assert sum(p[1] for p in parts) == 100
    assert sorted(sum(p[1] for p in parts if p[2] == s) for s in range(3)) == [33, 33, 34]


# 8


def test_bpe(docs, given, none):
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(tokenizer_path())
    known.no_truncation()
    known.no_padding()
    for table in (docs, given):
        expected = [(i, *plain.tokens(known, t)) for i, t in pairs(table)]
        same(bpe.op8(table, tokenizer_path()), ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], expected)
    assert bpe.op8(none, tokenizer_path()).count() == 0


def test_bpe_in_small_blocks(given):
    names = ["row", "ids", "decoded"]
    assert rows(bpe.encode(given, tokenizer_path(), block_bytes=4096, parts=8), *names) == rows(bpe.encode(given, tokenizer_path()), *names)


def test_bpe_without_an_id(spark):
    table = spark.createDataFrame([(None, "one two"), (-1, "three")], "doc_id long, text string")
    assert sorted(repr(r.doc_id) for r in bpe.op8(table, tokenizer_path()).collect()) == ["-1", "None"]


# 9


def test_near(docs, given, none):
    for table in (docs, given):
        same(simhash.op9(table), ["doc_id", "fingerprint", "component_id"], plain.near(pairs(table)))
    assert simhash.op9(none).count() == 0


@pytest.mark.parametrize("n", range(1, 41))
def test_forest_of_small_nodes(n):
    """Links of one node or of several, in batches cut anywhere, join what a plain search joins."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(n)
    codes = np.unique(np.concatenate([rng.integers(-(1 << 62), 1 << 62, n // 2 + 1), [c ^ (1 << int(b)) for c, b in zip(rng.integers(0, 8, n), rng.integers(0, 60, n))]]))[:n]
    for nodes in (np.zeros(len(codes), np.int64), np.sort(rng.integers(0, 3, len(codes)))):
        for size in (1, 3, 7, 100):
            batches = [pa.RecordBatch.from_arrays([pa.array(np.zeros(len(codes), np.int64)[i:i + size]), pa.array(nodes[i:i + size]), pa.array(codes[i:i + size])], ["mask", "pattern", "code"]) for i in range(0, len(codes), size)]
            links = [(int(a), int(b)) for out in simhash._forest(iter(batches), 4) for a, b in zip(out.column(0).to_pylist(), out.column(1).to_pylist())]
            every = [(int(a), int(b)) for x, a in zip(nodes, codes) for y, b in zip(nodes, codes) if x == y and ((int(a) ^ int(b)) & ((1 << 64) - 1)).bit_count() <= 4]
            assert plain.classes(codes.tolist(), links) == plain.classes(codes.tolist(), every)


def test_near_dedup_keeps_one_row(docs):
    found = simhash.near_dedup(docs)
    assert found.columns == docs.columns
    assert sorted(r.doc_id for r in found.collect()) == sorted({c for _, _, c in plain.near(pairs(docs))})


# 1, 4


def test_toxicity_of_held_out(spark):
    at = "/root/testdata/sf0.1"
    table, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")
    found = toxicity.op1(table, labels).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    bad, clean = [r for r in found if r.toxic == 1], [r for r in found if r.toxic == 0]
    assert sum(r.predicted for r in bad) >= 0.8 * len(bad)
    assert sum(r.predicted for r in clean) <= 0.05 * len(clean)


def test_search_finds_what_a_plain_scan_finds():
    """Blocks that the bound leaves out hold no nearer example."""
    import numpy as np

    rng = np.random.default_rng(4)
    vocabulary = [b"=w%d" % i for i in range(300)]
    rows = [np.sort(rng.choice(300, rng.integers(1, 40), replace=False, p=np.linspace(2, 0, 300) / 300)) for _ in range(700)]
    weights = [(w := rng.random(len(r)) + 0.05) / np.linalg.norm(w) for r in rows]
    index = toxicity.Index(vocabulary, rng.random(300) + 0.5, np.arange(700), np.zeros(700), np.array([len(r) for r in rows]), np.concatenate(rows), np.concatenate(weights))
    dense = np.zeros((700, 300))
    for i, (r, w) in enumerate(zip(rows, weights)):
        dense[i, r] = w
    for _ in range(60):
        found, v = index.query(Counter({b"w%d" % i: int(rng.integers(1, 4)) for i in rng.choice(300, 25, replace=False)}))
        plain_cosines = dense[:, found] @ v
        best, cosine = index.nearest(found, v)
        expected = np.lexsort((np.arange(700), -np.round(plain_cosines, 9)))[:toxicity.NEIGHBOURS]
        assert np.allclose(cosine, plain_cosines[expected], atol=1e-6) and set(best) == set(expected[plain_cosines[expected] > 0])


def test_few_labels_still_tell(spark):
    """Every example and every document with a word of the examples has a vector, also where labels are few."""
    at = "/root/testdata/sf0.001"
    table, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")
    assert len({r.score for r in toxicity.op1(table, labels).collect()}) > 1


def test_toxicity_edges(docs, none, spark):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(-1, 9)], "doc_id long, toxic int, quality int")
    for table, known, n in ((docs, labels, len(ROWS)), (none, labels, 0), (docs, labels.where("false"), len(ROWS)), (docs, labels.withColumn("toxic", F.lit(None).cast("int")), len(ROWS))):
        found = toxicity.op1(table, known).collect()
        assert len(found) == n and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)


def test_language_of_held_out(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.op4(table).join(table.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert sum(r.lang_pred == r.lang for r in found) >= 0.95 * len(found)


def test_language_edges(docs, none):
    found = {r.doc_id: r.lang_pred for r in language.op4(docs).collect()}
    assert [found[i] for i in (2, 3, 5, 7)] == ["und"] * 4
    assert language.op4(none).count() == 0
    assert {r.lang_pred for r in language.op4(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


# 5, 10


def test_line_dedup(spark):
    pages = [(i, f"https://Site.org/{i}", f"<p>Home</p><p>Text number {i}</p><p>Imprint</p>", 1, "x") for i in range(12)]
    pages += [(20, "https://other.org/", "<p>Home</p>", 1, "x"), (21, None, None, None, None), (22, "https://site.org/e", "", None, None)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string, n_lines int, site string")
    found = {r.page_id: r for r in lines.op5(table).collect()}
    assert len(found) == len(pages)
    assert found[3].text == "Text number 3" and found[3].host == "site.org" and (found[3].n_lines, found[3].n_dropped) == (3, 2)
    assert found[20].text == "Home" and found[21].text == "" and found[22].n_lines == 0
    assert lines.op5(table.where("false")).count() == 0


def test_line_dedup_keeps_clashing_columns(spark):
    table = spark.createDataFrame([(i, 77, "d", [f"Home|line {i}"], "h") for i in range(12)], "page_id long, _salt long, _drops string, _lines array<string>, host string")
    found = lines.line_dedup(table, F.split(F.get("_lines", F.lit(0)), "[|]"), F.col("host"), "page_id")
    names = ["page_id", "_salt", "_drops", "_lines", "host"]
    assert rows(found, *names) == rows(table, *names)
    assert {tuple(r.kept_lines) for r in found.collect()} == {(f"line {i}",) for i in range(12)}


def test_extraction(spark):
    body = "<p>The first paragraph, with a few commas, is long enough to count as text of the article.</p><p>A second one,\n follows &amp; it has   <b>bold</b> words, too, so that the container wins.</p>"
    html = f"<html><head><title>t</title><style>p {{}}</style></head><body><nav><a href='/'>Home</a> <a href='/b'>Blog</a></nav><header>Site</header><article>{body}</article><aside class='sidebar'><p>Buy, now, this, thing</p></aside><footer>Imprint</footer><script>var a = '<p>no</p>';</script></body></html>"
    table = spark.createDataFrame([(1, "u", html), (2, None, None), (3, "u", ""), (4, "u", "<div><p>unclosed"), (4, "u", "<<<>>&#x110000;&bogus;")], "page_id long, url string, html string")
    found = extraction.op10(table).collect()
    assert len(found) == 5 and all(r.n_chars == len(r.text) for r in found)
    one = next(r for r in found if r.page_id == 1).text
    assert one == "The first paragraph, with a few commas, is long enough to count as text of the article.\n\nA second one, follows & it has bold words, too, so that the container wins."
    assert {r.text for r in found if r.page_id in (2, 3)} == {""}
    assert extraction.op10(table.where("false")).count() == 0


def test_lines_by_quick_patterns(spark):
    """The patterns that Java finds fast give the lines that the stated ones give, and lone blanks are no work."""
    import re

    odd = [
        "a \t b<br>c  d\n\ne <B>f</B> <P >g<PRE>h</pre><p/>i</ p><pa>j<!-- k\n-->l<!-->m-->", "<SCRIPT a=1>x</script>y<style>z</STYLE >w<style>v</style>", "<script>1</style>2</script>3<noscript>4</noscript>", "<scripts>5</scripts>6",
        "<head><title>t</title></head><header>u</header><h1>v</h1><h7>w</h7><th x=\"1\ny\">x</th><thead>y", " \x0b ", "a<", "a<p", None, "  a <b> </b> c ", "<tr\n>1<td>2</li\x0c>3<articles>4<asides>5</aside>6",
    ]
    table = spark.createDataFrame(list(enumerate(odd)), "page_id long, html string")
    text = F.regexp_replace(F.regexp_replace(F.coalesce("html", F.lit("")), r"[\x20\x09-\x0D]+", " "), lines.UNSEEN_PATTERN, " ")
    text = F.regexp_replace(F.regexp_replace(text, lines.BREAK_PATTERN, "\n"), "<[^>]*>", "")
    plain = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(F.regexp_replace(x, " +", " "))), lambda x: x != "")
    for r in table.select("page_id", lines.visible_lines("html").alias("quick"), plain.alias("plain")).collect():
        assert r.quick == r.plain, odd[r.page_id]
    assert re.search(lines._SPACES, "a lone blank") is None


def test_texts_searched_at_once():
    """Texts searched together find what each finds alone, without the examples that each leaves out."""
    import numpy as np

    rng = np.random.default_rng(4)
    draw = lambda n: (np.sort(rng.choice(1500, n, replace=False)), rng.random(n) + 0.1)
    rows = [draw(int(rng.integers(1, 60))) for _ in range(300)]
    rows += rows[:20]
    flat, weights = (np.concatenate([r[i] / (np.linalg.norm(r[1]) if i else 1) for r in rows]) for i in (0, 1))
    sizes, ids = np.array([len(r[0]) for r in rows]), np.arange(len(rows)) % 300
    index = toxicity.Index([b"=%d" % i for i in range(1500)], np.ones(1500), ids, np.zeros(len(rows)), sizes, flat.astype(np.int64), weights)
    queries = [(f, v / np.linalg.norm(v)) for f, v in [*rows[:40], *(draw(5) for _ in range(20))]] + [(np.zeros(0, np.int64), np.zeros(0))]
    left_out = [i if i < 40 and i % 2 else None for i in range(len(queries))]
    dense = np.zeros((len(rows), 1500))
    dense[np.repeat(np.arange(len(rows)), sizes), flat.astype(np.int64)] = weights
    for (found, v), out, (best, cosine) in zip(queries, left_out, index.search(queries, without=left_out)):
        plain_cosines = dense[:, found] @ v
        plain_cosines[ids == (-1 if out is None else out)] = 0
        expected = np.lexsort((np.arange(len(rows)), -np.round(plain_cosines, 9)))[: toxicity.NEIGHBOURS]
        expected = expected[plain_cosines[expected] > 0]
        assert best.tolist() == expected.tolist() and np.allclose(cosine, np.minimum(plain_cosines[expected], 1))
