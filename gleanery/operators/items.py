"""From pages and API rows to items: positional, textual and embedded extraction, nested and flat shapes."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery import schemas
from gleanery.functions import context
from gleanery.functions.grading import derive_tags, infer_difficulty
from gleanery.functions.markup import (
    FORGE_URL,
    ISSUE_REFERENCE,
    clean_title,
    extract_amounts,
    extract_attr,
    extract_issues,
    extract_titles,
    find_all,
    issue_parts,
    issue_title,
    issue_url,
    reference_parts,
    with_page_text,
)
from gleanery.functions.scalars import (
    cents_to_usd,
    flag_or_false,
    format_reward,
    format_usd,
    issue_hash,
    item_key,
    let,
    number_or,
    text_or,
)
from gleanery.functions.variants import as_kind, at, first_at, first_truthy, number_at, text_at
from gleanery.operators.keyed import settled

DEFAULT_CENTS = 10000
PAGE_PROPS = "$.props.pageProps"
EMBEDDED_SCRIPT = r'(?s)<script[^>]*id="__NEXT_DATA__"[^>]*>(.*?)</script>'


# --- items by position in one page -----------------------------------------------------------------


def positional_items(
    pages: DataFrame, issues: DataFrame | None = None, site_name: str | None = None, default_title: str = "Bounty"
) -> DataFrame:
    """Flat items of each page, pairing the i-th amount with the i-th id, issue and title.

    All arrays are found while the page is scanned and cut to the number of amounts, so only items
    travel on. A missing id or title takes a numbered default; the first item of an id stays. ``issues``
    brings real titles by (owner, repo, number).
    """
    keep = [c for c in pages.columns if c != "html"]
    found = F.struct(
        extract_amounts("html").alias("amounts"),
        extract_attr("html").alias("ids"),
        extract_issues("html").alias("issues"),
        extract_titles("html", site_name).alias("titles"),
    )

    def pair(f: Column) -> Column:
        def one(amount: Column, i: Column) -> Column:
            number = i.cast("string")
            return F.struct(
                i.cast("int").alias("pos"),
                text_or(F.get(f["ids"], i), F.concat(F.lit("unknown-"), number)).alias("id"),
                amount.alias("amount_usd"),
                F.get(f["issues"], i).alias("issue"),
                F.coalesce(F.get(f["titles"], i), F.concat(F.lit(f"{default_title} "), (i + 1).cast("string"))).alias("title"),
            )

        return F.transform(f["amounts"], one)

    def first_of_id(rows: Column) -> Column:
        ids = F.transform(rows, lambda r: r["id"])
        firsts = F.filter(rows, lambda r, i: F.array_position(ids, r["id"]) == i + 1)
        # Ids are distinct by construction unless a page uses a padded name itself.
        return F.when(F.size(F.array_distinct(ids)) == F.size(rows), rows).otherwise(firsts)

    items = (
        pages.select(*keep, F.explode_outer(let(let(found, pair), first_of_id)).alias("_i"))
        .where("_i IS NOT NULL")
        .select(
            *keep, "_i.pos", "_i.id", "_i.amount_usd", F.col("_i.title").alias("_title"),
            F.col("_i.issue.owner").alias("owner"), F.col("_i.issue.repo").alias("repo"), F.col("_i.issue.number").alias("number"),
        )
    )
    if issues is not None:
        known = issues.select("owner", "repo", "number", F.col("title").alias("_real"))
        items = items.join(known, ["owner", "repo", "number"], "left").withColumn("_title", text_or("_real", F.col("_title")))
    repo = F.col("repo")
    return items.select(
        *keep, "pos", "id",
        clean_title("_title", site_name).alias("title"),
        "amount_usd",
        format_usd("amount_usd").alias("amount_formatted"),
        F.lit("open").alias("status"),
        F.coalesce(issue_url(F.col("owner"), repo, F.col("number")), F.col("url") if "url" in keep else F.lit(None)).alias("item_url"),
        derive_tags("_title", "repo").alias("tags"),
        F.when(
            repo.isNotNull(),
            F.struct(F.col("owner"), repo.alias("name"), F.concat(F.lit(FORGE_URL), "owner", F.lit("/"), repo).alias("url")),
        ).alias("repository"),
        F.col("number").alias("issue_number"),
        infer_difficulty("amount_usd", "_title").alias("difficulty"),
    )


# --- items by issue reference in text --------------------------------------------------------------


def mentions(text: Column | str, raw: bool = False, legacy_commas: bool = False) -> Column:
    """Array of issue references in a text with what their surroundings say.

    References are found and the text is split once; each reference finds its line by its place in the text, and
    all that is read around it comes from its few lines, joined once.
    """
    whole = F.col(text) if isinstance(text, str) else text
    return F.transform(let(let(whole, lambda page: _split(page, raw)), _surroundings), lambda r: _said(r, legacy_commas))


def _split(page: Column, raw: bool = False) -> Column:
    """References, lines and the text itself."""
    matches = find_all(page, ISSUE_REFERENCE, 0)
    return F.struct((matches if raw else F.array_distinct(matches)).alias("matches"), context.text_lines(page).alias("lines"), page.alias("text"))


def _surroundings(page: Column) -> Column:
    """Of each reference of a split text its ref_url, its lines and these joined."""

    def one(ref: Column) -> Column:
        around = let(context.line_of(page["text"], ref).cast("int"), lambda hit: F.when(hit.isNotNull(), context.lines_around(page["lines"], hit)))
        return let(around, lambda lines: F.struct(ref.alias("ref_url"), lines.alias("lines"), context.joined_lines(lines).alias("joined")))

    return F.transform(page["matches"], one)


def _said(r: Column, legacy_commas: bool = False) -> Column:
    """What the surroundings of a reference say."""
    return F.struct(
        reference_parts(r["ref_url"]).alias("issue"),
        context.context_title(r["lines"]).alias("title"),
        context.amount_cents(r["joined"], legacy_commas).alias("cents"),
        let(context.matching_terms(r["joined"], context.CONTEXT_TERMS), lambda terms: F.nullif(terms, _strings())).alias("tech"),
        F.substring(r["joined"], 1, 200).alias("context"),
        r["ref_url"].alias("ref_url"),
    )


def text_items(pages: DataFrame, text: str = "text", raw: bool = False, legacy_commas: bool = False) -> DataFrame:
    """Issue references in page text, one row per distinct reference of a page; ``raw`` keeps every mention.

    Columns: the page's own, owner, repo, number, title, cents, tech, context, ref_url.
    """
    keep = [c for c in pages.columns if c != text]
    return (
        pages.select(*keep, F.explode_outer(mentions(text, raw, legacy_commas)).alias("_r"))
        .where("_r IS NOT NULL")
        .select(*keep, "_r.issue.*", "_r.title", "_r.cents", "_r.tech", "_r.context", "_r.ref_url")
    )


# --- items in embedded page state ------------------------------------------------------------------


def embedded_state(html: Column | str) -> Column:
    """Page-state JSON as a variant; NULL when the page has none or it does not parse."""
    c = F.col(html) if isinstance(html, str) else html
    return let(F.regexp_extract(c, EMBEDDED_SCRIPT, 1), lambda found: F.try_parse_json(F.nullif(found, F.lit(""))))


def _task(item: Column) -> Column:
    return first_truthy(at(item, "$.task"), item)


def _reference(url: Column) -> Column:
    """(owner, repo, number) of an issue URL, NULL for other URLs."""
    return F.when(F.rlike(url, F.lit(ISSUE_REFERENCE)), issue_parts(url))


_URL_PATHS = ("$.url", "$.html_url", "$.source.data.html_url")


def candidates(state: Column) -> Column:
    """Pre-extracted candidates in a page state: array of (id, title, url, cents, currency, body, issue)."""
    # Where candidates may be, in order.
    spots = ["$.bounties", "$.items", "$.data.bounties", "$.data.items"]
    listed = let(at(state, PAGE_PROPS), lambda props: as_kind(first_at(props, *spots), "array<variant>"))
    blank = F.lit("")

    def pair(item: Column) -> Column:
        return let(_task(item), lambda t: F.struct(item.alias("item"), t.alias("task"), text_at(t, *_URL_PATHS).alias("url")))

    def read(p: Column) -> Column:
        item, task = p["item"], p["task"]
        return F.struct(
            F.coalesce(text_at(item, "$.id"), blank).alias("id"),
            F.coalesce(text_at(task, "$.title", "$.source.data.title"), blank).alias("title"),
            p["url"].alias("url"),
            F.coalesce(number_at(item, "$.reward.amount", "$.amount"), F.lit(0)).alias("cents"),
            F.coalesce(text_at(item, "$.reward.currency", "$.currency"), F.lit("USD")).alias("currency"),
            F.coalesce(text_at(task, "$.body", "$.source.data.body"), blank).alias("body"),
            _reference(p["url"]).alias("issue"),
        )

    found = F.filter(F.transform(listed, pair), lambda p: F.contains(p["url"], F.lit("github.com")))
    return F.transform(found, read)


def embedded_candidates(pages: DataFrame, state: str = "state") -> DataFrame:
    """Pre-extracted candidates that point to the forge; owner, repo and number are NULL for other links."""
    keep = [c for c in pages.columns if c != state]
    rows = pages.select(*keep, F.posexplode_outer(candidates(F.col(state))).alias("pos", "_c")).where("_c IS NOT NULL")
    fields = [f"_c.{n}" for n in ("id", "title", "url", "cents", "currency", "body")]
    return rows.select(*keep, "pos", *fields, "_c.issue.owner", "_c.issue.repo", "_c.issue.number")


def raw_objects(state: Column) -> Column:
    """Raw objects in a page state that belong to an issue: array of (item, issue_url, issue)."""
    # Where the raw list may be, in order.
    spots = ["$.bounties", "$.items", "$.data"]
    listed = let(at(state, PAGE_PROPS), lambda props: as_kind(first_at(props, *spots), "array<variant>"))

    def read(item: Column) -> Column:
        url = let(_task(item), lambda t: text_at(t, *_URL_PATHS))
        return let(url, lambda u: F.struct(item.alias("item"), u.alias("issue_url"), _reference(u).alias("issue")))

    return F.filter(F.transform(listed, read), lambda r: r["issue"].isNotNull())


def embedded_raw_rows(pages: DataFrame, state: str = "state") -> DataFrame:
    """Raw candidate objects (pos, item, issue_url) with their issue parts."""
    keep = [c for c in pages.columns if c != state]
    rows = pages.select(*keep, F.posexplode_outer(raw_objects(F.col(state))).alias("pos", "_r")).where("_r IS NOT NULL")
    return rows.select(*keep, "pos", "_r.item", "_r.issue_url", "_r.issue.*")


# --- the best source of a page ---------------------------------------------------------------------

FROM_CANDIDATES, FROM_RAW, FROM_TEXT = 1, 2, 3
_NEAR = "struct<ref_url: string, lines: array<string>, joined: string>"


def _none(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _names_state(html: str) -> Column:
    return F.contains(html, F.lit("__NEXT_DATA__"))


def _state_rows(html: str) -> Column:
    """Issues in the embedded state of a page: pre-extracted ones, or raw ones where there are none."""

    def row(source: int, issue: Column, **known: Column) -> Column:
        unknown = {
            "id": _none("string"), "title": _none("string"), "body": _none("string"), "link": _none("string"),
            "cents": _none("bigint"), "currency": F.lit("USD"), "tech": _none("array<string>"), "item": _none("variant"),
        }
        return F.struct(
            F.lit(source).alias("source"), issue.alias("issue"), *[c.alias(n) for n, c in {**unknown, **known}.items()]
        )

    def from_state(state: Column) -> Column:
        ready = F.filter(candidates(state), lambda c: c["issue"].isNotNull())
        as_rows = F.transform(
            ready,
            lambda c: row(
                FROM_CANDIDATES, c["issue"], id=c["id"], title=c["title"], body=c["body"], link=c["url"], cents=c["cents"],
                currency=c["currency"],
            ),
        )
        return let(
            as_rows,
            lambda found: F.when(F.size(found) > 0, found).otherwise(
                F.transform(raw_objects(state), lambda r: row(FROM_RAW, r["issue"], link=r["issue_url"], item=r["item"]))
            ),
        )

    return let(embedded_state(html), from_state)


def pages_of_best_source(pages: DataFrame, most: int = 1_000_000) -> DataFrame:
    """The pages (handle, html, ...) without those that only have text where the organization's state has issues.

    What such pages say is left out by ``organization_rows``; without them it is neither worked out nor moved. This runs jobs: one finds
    the organizations with pages of both kinds, the next those of them whose state has an issue. Only handles are moved, and up to
    ``most`` (about 100 bytes each) are sent to the readers; if there are more, all pages stay.
    """
    named = F.coalesce(_names_state("html"), F.lit(False))
    kinds = pages.groupBy("handle").agg(F.max(named).alias("_any"), F.min(named).alias("_all"))
    both = settled(kinds.where("_any AND NOT _all").select("handle"))
    if not 0 < both.limit(most + 1).count() <= most:
        return pages
    # Inside the aggregate, states are worked out above the join; a filter would move below it.
    told = F.max(F.size(_state_rows("html")) > 0).alias("_told")
    stated = settled(pages.where(named).join(F.broadcast(both), "handle", "left_semi").groupBy("handle").agg(told).where("_told").select("handle"))
    if stated.isEmpty():
        return pages
    served = F.broadcast(stated.withColumnRenamed("handle", "_stated"))
    return pages.join(served, (F.col("handle") == F.col("_stated")) & ~named, "left_anti")


def best_source_rows(pages: DataFrame) -> DataFrame:
    """References of each page (handle, html, ...) from its best source, in one scan.

    The first of pre-extracted state, raw state and text that has any issue wins; later ones are not
    worked out. Columns: the page's own, pos (place in the page), source, owner, repo, number and what that
    source knows. What an organization's pages give together is ``organization_rows``.
    """
    keep = [c for c in pages.columns if c != "html"]
    # Text is worked out only of pages whose state has nothing. What surrounds a reference is found within its page, what it says
    # is read after the references are apart, where Spark compiles it.
    read = pages.select(*keep, "html", F.when(_names_state("html"), _state_rows("html")).alias("_state"))
    left = read.select(*keep, "_state", F.when(F.size("_state") > 0, F.lit(None)).otherwise(F.col("html")).alias("html"))
    split = with_page_text(left, "html", "_text").select(*keep, "_state", F.col("_text"), find_all("_text", ISSUE_REFERENCE, 0).alias("_matches"))
    said = F.struct(F.array_distinct("_matches").alias("matches"), context.text_lines("_text").alias("lines"), F.col("_text").alias("text"))
    nothing = F.lit(None)
    # The page's columns travel inside the exploded rows, so no later join by them can move below the
    # extraction and drag the HTML through an exchange.
    carried = F.when(F.size("_state") > 0, F.transform("_state", lambda s: F.struct(*keep, s.alias("state"), nothing.cast(_NEAR).alias("near")))).when(
        F.size("_matches") > 0, F.transform(let(said, _surroundings), lambda n: F.struct(*keep, nothing.alias("state"), n.alias("near")))
    )
    rows = split.select(F.posexplode_outer(carried).alias("pos", "_r")).where("_r IS NOT NULL")
    apart = rows.select(*[f"_r.{c}" for c in keep], "pos", F.col("_r.state").alias("_state"), F.col("_r.near").alias("_near"))
    known = apart.select(*keep, "pos", "_state", F.when(F.col("_state").isNull(), _said(F.col("_near"))).alias("_said"))
    said_there = {"source": F.lit(FROM_TEXT), "title": "_said.title", "body": "_said.context", "link": "_said.ref_url", "cents": "_said.cents", "currency": F.lit("USD"), "tech": "_said.tech"}

    def either(name: str) -> Column:
        there = said_there.get(name)
        other = _none("variant") if name == "item" else _none("string") if there is None else F.col(there) if isinstance(there, str) else there
        return F.when(F.col("_state").isNull(), other).otherwise(F.col(f"_state.{name}")).alias(name)

    parts = [F.when(F.col("_state").isNull(), F.col(f"_said.issue.{p}")).otherwise(F.col(f"_state.issue.{p}")).alias(p) for p in ("owner", "repo", "number")]
    return known.select(*keep, "pos", *[either(n) for n in ("source", "id", "title", "body", "link", "cents", "currency", "tech", "item")], *parts)


_ISSUE = ["handle", "owner", "repo", "number"]


def organization_rows(rows: DataFrame, page: Sequence[str] = ()) -> DataFrame:
    """Rows of ``best_source_rows`` as each organization's: its best source, and one row per issue.

    The best source of an organization is the least of all its pages; what pages of a lesser source say is
    left out. An issue that several pages or places name counts once, as the first in the order of the
    ``page`` columns and the place in the page has it; without an order of pages the content settles it.

    Rows are reduced per issue first, an aggregate with a map-side part whose best source comes first, and an
    organization's best source is then found from the reduced rows. Those of a hot organization are on the
    left of the join, whose right side holds one row per organization. A row is moved once, as the value that is
    compared; only values without an order are moved beside it.
    """
    order = ["source", *page, "pos", "cents", "title", "link", "body"]
    others = [c for c in rows.columns if c not in _ISSUE]
    # Raw items and maps have no order. The first row that has any comes beside the least row, and is mostly NULL.
    loose = [f.name for f in rows.schema if f.name in others and re.search(r"\b(variant|map)\b", f.dataType.simpleString())]
    row = F.struct(*order, *[c for c in others if c not in order and c not in loose])
    has_loose = reduce(or_, [F.col(c).isNotNull() for c in loose], F.lit(False))
    beside = F.struct(row.alias("of"), *loose)
    # The hash comes first, so that sorting by these columns seldom has to look at the texts.
    least = rows.groupBy(F.xxhash64(*_ISSUE).alias("_key"), *_ISSUE).agg(F.min(row).alias("_row"), F.min_by(beside, F.when(has_loose, row)).alias("_beside"))
    taken = lambda value: F.struct(*[value(c) if c in loose else F.col(f"_row.{c}").alias(c) for c in others])
    nothing = taken(lambda c: F.lit(None).cast(rows.schema[c].dataType).alias(c))
    # One value made of both, so that neither is pruned and rows are worked out once for the two sides of the join.
    chosen = F.when(F.col("_beside.of") == F.col("_row"), taken(lambda c: F.col(f"_beside.{c}").alias(c))).otherwise(nothing)
    once = least.select(*_ISSUE, chosen.alias("_chosen")).select(*_ISSUE, "_chosen.*")
    best = once.groupBy("handle").agg(F.min("source").alias("_best"))
    return once.join(best, "handle").where("source = _best").select(*rows.columns)


# --- nested items ----------------------------------------------------------------------------------


def _strings() -> Column:
    return F.array().cast("array<string>")


def _objects() -> Column:
    return F.array().cast("array<variant>")


def _avatar(handle: Column) -> Column:
    return F.concat(F.lit("https://avatars.githubusercontent.com/u/"), handle, F.lit("?v=4"))


def organization_struct(created_at: Column, forge_handle: Column) -> Column:
    """Organization part of an item from the registry columns handle, display_name, description, org_tech."""
    handle = F.col("handle")
    values = {
        "handle": handle, "id": F.concat(F.lit("generated-"), handle), "name": F.col("display_name"),
        "description": text_or("description", ""), "members": _objects(), "display_name": F.col("display_name"),
        "created_at": created_at, "website_url": F.lit(""), "avatar_url": _avatar(handle), "discord_url": F.lit(""),
        "slack_url": F.lit(""), "stargazers_count": F.lit(0).cast("bigint"), "twitter_url": F.lit(""), "youtube_url": F.lit(""),
        "tech": F.coalesce("org_tech", _strings()), "github_handle": forge_handle, "accepts_sponsorships": F.lit(False),
        "days_until_timeout": F.lit(None).cast("bigint"), "enabled_expert_recs": F.lit(False), "enabled_private_bounties": F.lit(False),
    }
    return F.struct(*[c.alias(n) for n, c in values.items()])


def team_user(
    user_id: Column | None = None, login: Column | None = None, avatar: Column | None = None, page: Column | None = None
) -> Column:
    """Author object; parts that are not known name the organization's team."""
    handle, name = F.col("handle"), F.col("display_name")
    given = lambda c, default: default if c is None else text_or(c, default)
    values = {
        "id": F.lit(0).cast("bigint") if user_id is None else F.coalesce(user_id, F.lit(0)),
        "name": given(login, F.concat(name, F.lit(" Team"))), "location": F.lit(""), "company": name,
        "avatar_url": given(avatar, _avatar(handle)), "login": given(login, F.concat(handle, F.lit("-team"))),
        "twitter_username": F.lit(""),
        "html_url": given(page, F.concat(F.lit(FORGE_URL), handle, F.lit("-team"))),
    }
    return F.to_variant_object(F.struct(*[c.alias(n) for n, c in values.items()]))


def source_struct(key: Column, user: Column, title: Column, body: Column, html_url: Column) -> Column:
    data = F.struct(
        F.concat(F.lit("source-"), key).alias("id"), user.alias("user"), title.alias("title"), body.alias("body"),
        html_url.alias("html_url"),
    )
    return F.struct(data.alias("data"), F.lit("github").alias("type"))


def _assemble(given: dict[str, Column]) -> dict[str, Column]:
    """Columns of a nested item: given parts over the fixed ones, in schema order."""
    fixed = {
        "status": F.lit("open"), "type": F.lit("standard"), "kind": F.lit("dev"), "visibility": F.lit("public"),
        "autopay_disabled": F.lit(False), "tech": _strings(), "bids": _objects(), "is_external": F.lit(False),
        "manual_assignments": F.lit(False), "point_reward": F.lit(None).cast("bigint"), "reward_tiers": _objects(),
        "reward_type": F.lit("cash"), "timeouts_disabled": F.lit(False),
    }
    parts = {**fixed, **given}
    cents = parts.pop("cents")
    parts["reward"] = F.struct(parts.pop("currency").alias("currency"), cents.cast("bigint").alias("amount"))
    parts["reward_formatted"] = format_reward(cents)
    task = {
        "status": F.lit("open"), "type": F.lit("issue"), "tech": _strings(), "forge": F.lit("github"),
        **{k.removeprefix("task_"): parts.pop(k) for k in list(parts) if k.startswith("task_")},
    }
    parts["task"] = F.struct(*[task[n].alias(n) for n in schemas.names(schemas.TASK)])
    return {n: parts[n] for n in schemas.names(schemas.ITEM)}


def _rows(df: DataFrame, item: dict[str, Column], keep: Sequence[str]) -> DataFrame:
    return df.select(*keep, *[c.alias(n) for n, c in item.items()])


def items_from_listing(rows: DataFrame, as_of: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Nested items from listing API rows joined with their registry columns. Active rows only."""
    now = as_of.cast("timestamp")
    number = F.coalesce("issue.number", F.lit(0)).cast("bigint")
    title = issue_title(F.col("issue.title"), number=number)
    body, link = text_or("issue.body", ""), text_or("issue.html_url", "")
    created = F.coalesce("created_at", now)
    author = [F.col(f"issue.user.{f}") for f in ("id", "login", "avatar_url", "html_url")]
    item = _assemble(
        {
            "id": F.col("id"), "org": organization_struct(created, F.col("repo_owner")),
            "updated_at": F.coalesce("updated_at", now), "created_at": created,
            "currency": text_or("currency", "USD"), "cents": F.col("amount"),
            "task_id": F.concat(F.lit("task-"), "id"), "task_number": number, "task_title": title,
            "task_source": source_struct(F.col("id"), team_user(*author), title, body, link),
            "task_hash": issue_hash("repo_owner", "repo_name", number), "task_body": body, "task_url": link,
            "task_repo_name": F.col("repo_name"), "task_repo_owner": F.col("repo_owner"),
        }
    )
    return _rows(rows.where("status = 'active'"), item, keep)


def reference_item(columns: Sequence[str], as_of: Column) -> dict[str, Column]:
    """Nested item of a row with owner, repo, number, id, title, body, link, cents, currency and tech.

    Looked-up issue columns (issue_title, issue_body, issue_html_url, issue_user) come first when the
    row has them.
    """
    now = as_of.cast("timestamp")
    looked_up = lambda name: F.col(f"issue_{name}") if f"issue_{name}" in columns else F.lit(None).cast("string")
    key = item_key("handle", "number")
    shown = issue_title(looked_up("title"), F.col("title"), number=F.col("number"))
    text = text_or(looked_up("body"), text_or("body", ""))
    url = text_or(looked_up("html_url"), F.col("link"))
    user = F.coalesce(F.col("issue_user"), team_user()) if "issue_user" in columns else team_user()
    tech = F.coalesce("tech", _strings())
    return _assemble(
        {
            "id": text_or("id", key), "org": organization_struct(now, F.col("owner")), "updated_at": now, "created_at": now,
            "currency": text_or("currency", "USD"), "cents": number_or("cents", DEFAULT_CENTS), "tech": tech,
            "task_id": F.concat(F.lit("task-"), key), "task_number": F.col("number"), "task_title": shown,
            "task_source": source_struct(key, user, shown, text, url),
            "task_hash": issue_hash("owner", "repo", "number"), "task_body": text, "task_url": url, "task_tech": tech,
            "task_repo_name": F.col("repo"), "task_repo_owner": F.col("owner"),
        }
    )


def items_from_candidates(rows: DataFrame, as_of: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Nested items from pre-extracted candidates (``embedded_candidates`` plus registry columns)."""
    given = rows.where("number IS NOT NULL").withColumns({"link": F.col("url"), "tech": _strings()})
    return _rows(given, reference_item(given.columns, as_of), keep)


def items_from_text(rows: DataFrame, as_of: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Nested items from ``text_items`` rows plus registry columns."""
    given = rows.withColumns(
        {"id": F.lit(""), "body": F.col("context"), "link": F.col("ref_url"), "currency": F.lit("USD")}
    )
    return _rows(given, reference_item(given.columns, as_of), keep)


def with_task(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_task", _task(F.col("item")))


def embedded_item(as_of: Column, url: str = "issue_url") -> dict[str, Column]:
    """Nested item of a raw embedded object (see ``with_task``); absent or empty fields take their defaults."""
    now = as_of.cast("timestamp")
    item, task = F.col("item"), F.col("_task")
    text = lambda v, path: at(v, path, "string")
    flag = lambda path: flag_or_false(at(item, path, "boolean"))
    time = lambda path: F.coalesce(text(item, path).try_cast("timestamp"), now)
    listed = lambda v, path, kind: at(v, path, f"array<{kind}>")
    key = item_key("handle", "number")
    fallback = F.concat(F.lit("Issue #"), F.col("number").cast("string"))
    own_source = at(task, "$.source", schemas.nested(schemas.TASK_SOURCE))
    made_source = source_struct(
        key, team_user(), text_or(text(task, "$.title"), fallback), text_or(text(task, "$.body"), ""), F.col(url)
    )
    own_org = at(item, "$.org", schemas.nested(schemas.ORGANIZATION))
    task_tech = F.coalesce(listed(task, "$.tech", "string"), _strings())
    return _assemble(
        {
            "id": text_or(text(item, "$.id"), key), "status": text_or(text(item, "$.status"), "open"),
            "type": text_or(text(item, "$.type"), "standard"), "kind": text_or(text(item, "$.kind"), "dev"),
            "org": F.coalesce(own_org, organization_struct(time("$.created_at"), F.col("owner"))),
            "updated_at": time("$.updated_at"), "created_at": time("$.created_at"),
            "visibility": text_or(text(item, "$.visibility"), "public"), "autopay_disabled": flag("$.autopay_disabled"),
            "tech": F.coalesce(listed(item, "$.tech", "string"), task_tech),
            "bids": F.coalesce(listed(item, "$.bids", "variant"), _objects()), "is_external": flag("$.is_external"),
            "manual_assignments": flag("$.manual_assignments"),
            "point_reward": F.nullif(at(item, "$.point_reward", "bigint"), F.lit(0)),
            "currency": text_or(text(item, "$.reward.currency"), "USD"),
            "cents": number_or(at(item, "$.reward.amount", "bigint"), DEFAULT_CENTS),
            "reward_tiers": F.coalesce(listed(item, "$.reward_tiers", "variant"), _objects()),
            "reward_type": text_or(text(item, "$.reward_type"), "cash"), "timeouts_disabled": flag("$.timeouts_disabled"),
            "task_id": text_or(text(task, "$.id"), F.concat(F.lit("task-"), key)),
            "task_status": text_or(text(task, "$.status"), "open"), "task_type": text_or(text(task, "$.type"), "issue"),
            "task_number": F.col("number"),
            "task_title": text_or(text(task, "$.title"), text_or(text(task, "$.source.data.title"), fallback)),
            "task_source": F.coalesce(own_source, made_source), "task_hash": issue_hash("owner", "repo", "number"),
            "task_body": text_or(text(task, "$.body"), ""), "task_url": F.col(url), "task_tech": task_tech,
            "task_repo_name": F.col("repo"), "task_repo_owner": F.col("owner"),
        }
    )


def items_from_embedded(rows: DataFrame, as_of: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Nested items from raw embedded objects (``embedded_raw_rows`` plus registry columns)."""
    return _rows(with_task(rows), embedded_item(as_of), keep)


def items_from_best_source(rows: DataFrame, as_of: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Nested items from ``best_source_rows`` plus registry columns, in one projection."""
    raw, plain = embedded_item(as_of, url="link"), reference_item(rows.columns, as_of)
    is_raw = F.col("source") == FROM_RAW
    return _rows(with_task(rows), {n: F.when(is_raw, raw[n]).otherwise(plain[n]) for n in raw}, keep)


def flatten_items(items: DataFrame) -> DataFrame:
    """Nested items to flat rows with dollars."""
    return items.select(
        F.col("org.handle").alias("handle"), F.col("org.display_name").alias("display_name"), "id",
        F.col("task.title").alias("title"), cents_to_usd("reward.amount").alias("amount_usd"),
        F.col("task.url").alias("url"), "status", F.coalesce("tech", _strings()).alias("tags"), "created_at", "updated_at",
    )

