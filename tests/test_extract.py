"""Extraction from pages, text and embedded state."""

import pytest
from pyspark.sql import functions as F

from gleanery.functions import fingerprints, grading, markup, scalars
from gleanery.operators import discovery, items
from gleanery.plans import runs

PAIR = """
<section><p phx-value-id="k-90">
<h3 class="card-title">Cache the lookup table</h3> pays <b>$640</b>
see <a href="https://github.com/pine/cone/issues/8">the report</a></p>
<p phx-value-id="k-91"><h3 class="card-title">Rename a flag</h3> pays <b>$35</b>
see <a href="https://github.com/pine/needle/issues/2041">the report</a></p></section>
"""


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t STRING").select(column.alias("c")).first()["c"]


def positional(spark, html, **options):
    pages = spark.createDataFrame([("p", "https://x/p", html)], "handle STRING, url STRING, html STRING")
    return items.positional_items(pages, **options).orderBy("pos").collect()


def test_pair_of_items(spark):
    rows = positional(spark, PAIR)
    assert [(r["id"], r["amount_usd"], r["issue_number"], r["title"]) for r in rows] == [
        ("k-90", 640, 8, "Cache the lookup table"), ("k-91", 35, 2041, "Rename a flag"),
    ]
    assert [r["tags"] for r in rows] == [["cone"], ["needle"]]
    assert rows[0]["item_url"] == "https://github.com/pine/cone/issues/8" and rows[0]["amount_formatted"] == "$640"
    assert [r["difficulty"] for r in rows] == ["intermediate", "beginner"]


def test_empty_page(spark):
    assert positional(spark, "<h1>No items</h1>") == []


def test_amount_forms(spark):
    html = "".join(f'<i phx-value-id="z{i}">{a}</i>' for i, a in enumerate(("$31", "$48,007", "$9.90", "soon")))
    rows = positional(spark, html)
    assert [r["amount_usd"] for r in rows] == [31, 48007, 9.9]
    assert [r["item_url"] for r in rows] == ["https://x/p"] * 3 and rows[1]["title"] == "Bounty 2"


def test_padded_ids_keep_the_first(spark):
    html = '<i phx-value-id="unknown-1"></i>$5 $6 $7'
    assert [(r["id"], r["amount_usd"]) for r in positional(spark, html)] == [("unknown-1", 5), ("unknown-2", 7)]


def test_issue_titles_come_first(spark):
    issues = spark.createDataFrame([("pine", "cone", 8, "[Bug] Real one | extra"), ("pine", "needle", 2041, "")], "owner STRING, repo STRING, number BIGINT, title STRING")
    assert [r["title"] for r in positional(spark, PAIR, issues=issues)] == ["Real one", "Rename a flag"]


@pytest.mark.parametrize("title,clean", [("[Bug] [x] Fix it | repo", "[x] Fix it"), (" a · Site more", "a"), ("plain ", "plain"), ("|x", "")])
def test_clean_title(spark, title, clean):
    assert one(spark, title, markup.clean_title("t", "Site")) == clean


@pytest.mark.parametrize("html,md", [
    ("<h1>A</h1><p>b<br/>c</p>", "# A\nb\nc"),
    ('<a class="k" href="/u">go</a>', "[go](/u)"),
    ("&amp;lt;&nbsp;x", "< x"),
    ("<h2>a\nb</h2>", "a\nb"),
    ("<script>" + "<" * 20000 + "</script>ok", "ok"),
    ("a\n\n\n\n\nb", "a\n\nb"),
])
def test_markdown(spark, html, md):
    assert one(spark, html, markup.html_to_markdown("t")) == md


def test_tags_and_difficulty(spark):
    tags = one(spark, "Fix the API build", grading.derive_tags("t", F.lit("React-app")))
    assert tags == ["react-app", "javascript", "frontend", "api", "ui"]
    assert one(spark, "go api", grading.matching_terms("t", ["go", "ap"], match="word")) == ["go"]
    graded = [one(spark, t, grading.infer_difficulty(F.lit(a), "t")) for t, a in (("x", 2000), ("x", 1000), ("x", 500), ("security", 200), ("security", 100), ("fix", 300), ("x", 200), ("x", 1))]
    assert graded == ["expert", "advanced", "intermediate", "advanced", "intermediate", "beginner", "intermediate", "beginner"]
    assert [one(spark, "", grading.assign_tier(F.lit(n)))["tier"] for n in (10, 5, 1, 0)] == ["highly-active", "active", "emerging", "platform"]


def test_context(spark):
    text = "\n".join(f"line {i}" for i in range(8)) + "\n# A heading here\nUses Rust, pays $1,234,567.50\nsee github.com/o/r/issues/7\nend"
    pages = spark.createDataFrame([("p", text)], "handle STRING, text STRING")
    row = items.text_items(pages).first()
    assert (row["owner"], row["repo"], row["number"], row["title"]) == ("o", "r", 7, "A heading here")
    assert row["cents"] == 123456750 and row["tech"] == ["rust"] and row["context"].startswith("line 5 line 6")
    assert items.text_items(pages, legacy_commas=True).first()["cents"] == 123400
    twice = pages.withColumn("text", F.concat("text", F.lit("\n"), "text"))
    assert items.text_items(twice).count() == 1 and items.text_items(twice, raw=True).count() == 2


def test_fingerprint(spark):
    import hashlib

    html = "Bounty bounty $12 open \U0001f986"
    expected = hashlib.sha256(f"2-1-1{len(html) + 1}".encode()).hexdigest()[:16]
    assert one(spark, html, fingerprints.fingerprint("t")) == expected
    assert one(spark, html, fingerprints.estimate_items("t")) == 1
    assert one(spark, 'data-testid="bounty-card"' * 3, fingerprints.estimate_items("t")) == 3


def test_formats(spark):
    assert [one(spark, "", scalars.format_reward(F.lit(c))) for c in (10000, 150, 149, 50)] == ["$100", "$2", "$1", "$1"]
    assert [one(spark, "", scalars.format_usd(F.lit(x))) for x in (150.0, 1250.5, 12500000.0)] == ["$150", "$1250.5", "$12500000"]
    assert one(spark, "ab cD", scalars.capitalise("t")) == "Ab cD"
    assert one(spark, " a, b ,,c ", scalars.split_handles("t")) == ["a", "b", "c"]
    assert one(spark, "﻿  x \r\n", scalars.trim_text("t")) == "x"


EMBEDDED = '<script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":%s}}</script>'
WITH_TASK = '{"id":"x1","reward":{"amount":5000},"task":{"url":"https://github.com/o/r/issues/7","title":"T","source":{"data":{"title":"S","user":{"login":"me"}},"type":"github"}}}'
BARE = '{"id":"","amount":0,"html_url":"https://github.com/o/r/issues/8","org":{"handle":"zz","name":"Z"},"status":"closed"}'
OTHER = '{"id":"n","url":"https://example.com/1"}'


def orgs(spark, *handles):
    return spark.createDataFrame([(h, h.upper(), None, None) for h in handles], "handle STRING, display_name STRING, description STRING, org_tech ARRAY<STRING>")


def test_best_source_order(spark):
    pages = spark.createDataFrame(
        [
            ("first", EMBEDDED % f'{{"bounties":[{WITH_TASK},{BARE},{OTHER}]}}'),
            ("deep", EMBEDDED % f'{{"bounties":0,"data":{{"items":[{WITH_TASK}]}}}}'),
            ("raw", EMBEDDED % f'{{"data":[{WITH_TASK},{BARE}]}}'),
            ("emptied", EMBEDDED % f'{{"bounties":[],"items":[{WITH_TASK}]}}' + PAIR),
            ("text", PAIR), ("broken", EMBEDDED % "{" + PAIR), ("nothing", "<p></p>"),
        ],
        "handle STRING, html STRING",
    )
    handles = [r["handle"] for r in pages.collect()]
    as_of = F.lit("2025-01-01").cast("timestamp")
    found = runs.collect_items(orgs(spark, *handles), pages, as_of)
    got = {}
    for r in found.select("id", "org.handle", "reward.amount", "status", F.col("task.title").alias("title")).collect():
        got.setdefault(r["handle"], []).append((r["id"], r["amount"], r["status"], r["title"]))
    assert sorted(got["first"]) == [("first#8", 10000, "open", "Issue #8"), ("x1", 5000, "open", "T")]
    assert got["deep"] == [("x1", 5000, "open", "T")]
    assert got["raw"] == [("x1", 5000, "open", "T")]
    assert got["zz"] == [("raw#8", 10000, "closed", "Issue #8")]
    for handle in ("emptied", "text", "broken"):
        assert sorted(i[0] for i in got[handle]) == [f"{handle}#2041", f"{handle}#8"]
    assert "nothing" not in got


def test_text_is_only_read_of_organizations_without_state(spark):
    state = EMBEDDED % f'{{"bounties":[{WITH_TASK}]}}'
    raw = EMBEDDED % f'{{"data":[{BARE}]}}'
    pages = spark.createDataFrame(
        [
            (1, "both", state), (2, "both", PAIR), (3, "both", EMBEDDED % "{" + PAIR), (4, "raw", raw), (5, "raw", PAIR), (6, "empty", EMBEDDED % '{"bounties":[]}'),
            (7, "empty", PAIR), (8, "text", PAIR), (9, "text", None), (10, "state", state), (11, None, state), (12, None, PAIR), (13, "both", None),
        ],
        "page_id INT, handle STRING, html STRING",
    )
    read = items.pages_of_best_source(pages)
    assert sorted(r["page_id"] for r in read.collect()) == [1, 3, 4, 6, 7, 8, 9, 10, 11, 12]
    assert sorted(r["page_id"] for r in items.pages_of_best_source(pages, 2).collect()) == [*range(1, 14)]
    rows = lambda some: sorted(tuple(map(str, r)) for r in items.organization_rows(items.best_source_rows(some), ["page_id"]).collect())
    assert rows(read) == rows(pages) and {r[1] for r in rows(read)} == {"both", "raw", "empty", "text", "state"}
    found = runs.collect_items(orgs(spark, "both", "raw", "empty", "text", "state"), pages, F.lit("2025-01-01").cast("timestamp"))
    assert sorted(r["id"] for r in found.select("id").collect()) == ["empty#2041", "empty#8", "raw#8", "text#2041", "text#8", "x1", "x1"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan[plan.index("Generate posexplode"):]


def test_one_row_of_an_issue_with_all_that_belongs_to_it(spark):
    """The first in order, then by content; raw items and maps stay with their row, also if another row of the issue has some."""
    schema = "handle STRING, owner STRING, repo STRING, number LONG, source INT, page_id INT, pos INT, id STRING, title STRING, body STRING, link STRING, cents LONG, currency STRING, tech ARRAY<STRING>, more MAP<STRING, INT>, text STRING"
    row = lambda handle, number, source, page, ident, title=None, more=None, item=None: (handle, "o", "r", number, source, page, 0, ident, title, None, "l", 5, "USD", ["a"], more, item)
    given = [
        row("a", 1, 2, 1, None, None, {"k": 1}, '{"n":1}'), row("a", 1, 3, 0, None, "text"), row("a", 1, 2, 2, None, None, None, '{"n":2}'),
        row("a", 2, 3, 0, None, "lesser"), row("b", 1, 1, 1, "x"), row("b", 1, 1, 2, "y", None, {"k": 2}, '{"n":3}'), row("b", 2, 1, 1, "z"), row("b", 2, 1, 1, "w"),
        row(None, 1, 1, 1, "none"),
    ]
    rows = spark.createDataFrame(given, schema).withColumn("item", F.parse_json("text")).drop("text").repartition(3)
    found = items.organization_rows(rows, ["page_id"])
    assert found.columns == rows.columns
    got = {(r["handle"], r["number"]): (r["source"], r["page_id"], r["id"], r["title"], r["more"], r["n"], r["tech"]) for r in found.withColumn("n", F.expr("variant_get(item, '$.n', 'int')")).collect()}
    assert got == {("a", 1): (2, 1, None, None, {"k": 1}, 1, ["a"]), ("b", 1): (1, 1, "x", None, None, None, ["a"]), ("b", 2): (1, 1, "w", None, None, None, ["a"])}


def test_listing_comes_before_pages(spark):
    listing = spark.createDataFrame(
        [("a", '{"items":[{"id":"1","status":"active","amount":2500,"repo_owner":"o","repo_name":"r"},{"id":"2","status":"done","amount":1}]}'), ("b", '{"items":[{"id":"3","status":"done"}]}')],
        "handle STRING, body STRING",
    )
    from gleanery import schemas
    from gleanery.sources import readers

    rows = readers.listing_rows(readers.parse_documents(listing, "body", schemas.LISTING, ["handle"]))
    pages = spark.createDataFrame([("a", PAIR), ("b", PAIR)], "handle STRING, html STRING")
    found = runs.collect_items(orgs(spark, "a", "b"), pages, F.lit("2025-01-01").cast("timestamp"), listing=rows)
    assert sorted(r["id"] for r in found.collect()) == ["1", "b#2041", "b#8"]
    assert found.where("id = '1'").first()["reward_formatted"] == "$25"


def test_issue_lookup_fills_nested_items(spark):
    issues = spark.sql("SELECT 'pine' owner, 'cone' repo, 8L number, 'Real' title, 'B' body, 'https://h' html_url, parse_json('{\"login\":\"me\"}') user")
    pages = spark.createDataFrame([("a", PAIR)], "handle STRING, html STRING")
    found = runs.collect_items(orgs(spark, "a"), pages, F.lit("2025-01-01").cast("timestamp"), issues=issues)
    row = found.where("task.number = 8").select("task.title", "task.body", "task.url", F.expr("variant_get(task.source.data.user, '$.login', 'string') AS login")).first()
    assert tuple(row) == ("Real", "B", "https://h", "me")


def test_handles(spark):
    html = '<a href="/acme/bounties">x</a> <a href="/login">y</a> site.example/Zeta @me @x github.com/forge'
    pages = spark.createDataFrame([(html,), (html,)], "html STRING")
    found = lambda **o: sorted(r[0] for r in discovery.extract_handles(pages, discovery.link_patterns("site.example", **o)).collect())
    assert found() == ["Zeta", "acme", "me"]
    assert found(extended=True) == ["Zeta", "acme", "forge", "me"]


def test_page_facts_and_grading(spark):
    pages = spark.createDataFrame([("acme", "<title>Acme Corp - list</title> 7 bounties reward open task"), ("idle", "<h1>Idle</h1>")], "handle STRING, html STRING")
    facts = discovery.page_facts(pages)
    known = spark.createDataFrame([("acme",), ("ghost",)], "handle STRING")
    extra = spark.createDataFrame([("idle",), ("acme",)], "handle STRING")
    found, registry = runs.discover(known, [("links", extra)], facts, "https://s/{handle}/b")
    rows = {r["handle"]: r for r in found.collect()}
    assert (rows["acme"]["active"], rows["acme"]["item_count"], rows["acme"]["discovery_method"]) == (True, 7, "existing")
    assert (rows["idle"]["active"], rows["idle"]["validated"]) == (False, True)
    assert (rows["ghost"]["active"], rows["ghost"]["validated"]) == (False, False)
    assert [(r["handle"], r["tier"], r["scrape_interval"], r["url"]) for r in registry.collect()] == [("acme", "active", 1800, "https://s/acme/b")]


def test_number_candidates(spark):
    rows = [r["handle"] for r in discovery.number_candidates(spark, 1990, 1992, 2).orderBy("pos").collect()]
    assert rows == ["1990", "1991", "1992", "1", "v1", "x1", "2", "v2", "x2"]


def test_page_text_by_projections_says_the_same(spark):
    pages = [
        '<P class=x>See github.com/a/b/issues/12 $1,200.50</P><br/><SCRIPT>x</script>', '<h2>Fix</H2><h3>it</h3>\n\n\n\n&amp;&lt;<STYLE>b</STYLE>',
        '<a href="https://github.com/o/r/issues/77">An issue</a><A HREF="https://github.com/z">z</A>', "plain < text >", "   ", "", None, "İK<p>a</p><ſcript>",
    ]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")
    whole = df.select("page_id", markup.page_text("html").alias("text"))
    steps = markup.with_page_text(df, "html", "text")
    assert steps.columns == ["page_id", "text"]
    assert sorted(map(tuple, steps.collect())) == sorted(map(tuple, whole.collect()))


def test_values_are_worked_out_once(spark):
    """Neither the pattern of the embedded state nor a path into it is gone through twice for one value."""
    from gleanery.functions import variants

    df = spark.createDataFrame([(1, '<script id="__NEXT_DATA__">{"a":{"b":"c"}}</script>')], "page_id int, html string")
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    state = df.select(items.embedded_state("html").alias("state"))
    assert plan(state).count("regexp_extract") == 1
    found = spark.range(1).selectExpr("id", "parse_json(concat('{\"a\":', id, '}')) AS v")
    assert plan(found.select(variants.text_at("v", "$.a").alias("x"))).count("try_variant_get") == 1
    assert plan(found.select(variants.first_at("v", "$.a").alias("x"))).count("$.a") == 1
