"""Extraction from page HTML. Each builder reads one text column and needs no shuffle.

Arrays come out of the page in one pass per pattern, so callers can drop the HTML before any exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.scalars import NOT_NEWLINE, WHITESPACE, col, let, text_or, trim_text, utf16_length

# What the listing pages look like.
ITEM_ID_ATTRIBUTE = "phx-value-id"
AMOUNT = r"\$(\d+(?:,\d{3})*(?:\.\d{2})?)"
ISSUE_REFERENCE = r"github\.com/([^/]+)/([^/]+)/issues/(\d+)"
FORGE_URL = "https://github.com/"
TITLE_PATTERNS = (
    r"<title>([^<]+)</title>",
    r'class="[^"]*title[^"]*"[^>]*>([^<]+)<',
    r'href="[^"]*github\.com[^"]*"[^>]*>([^<]+)<',
)
ENTITIES = (
    ("&nbsp;", " "),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
)
ANY_TAG = r"<[^>]+>"
LINK_HREF = r'(?i)<a\b[^>]*href="([^"]*)"'


def find_all(text: Column | str, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(col(text), F.lit(pattern), F.lit(group))


def extract_attr(html: Column | str, attribute: str = ITEM_ID_ATTRIBUTE) -> Column:
    """Distinct values of an attribute, first-seen order."""
    return F.array_distinct(find_all(html, attribute + r'="([^"]+)"'))


def parse_amount(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("")).try_cast("double")


def extract_amounts(text: Column | str) -> Column:
    """Positive dollar amounts as doubles; all thousands commas are dropped."""
    return F.filter(F.transform(find_all(text, AMOUNT), parse_amount), lambda a: a > 0)


def reference_parts(match: Column) -> Column:
    """``issue_parts`` of a text that is one whole reference: its parts lie between slashes."""
    part = lambda n: F.split_part(match, F.lit("/"), F.lit(n))
    return F.struct(part(2).alias("owner"), part(3).alias("repo"), part(5).try_cast("bigint").alias("number"))


def issue_parts(match: Column) -> Column:
    part = lambda g: F.regexp_extract(match, ISSUE_REFERENCE, g)
    return F.struct(part(1).alias("owner"), part(2).alias("repo"), part(3).try_cast("bigint").alias("number"))


def extract_issues(text: Column | str) -> Column:
    """Array of (owner, repo, number) in page order, repeats kept. The page is scanned once."""
    return F.transform(find_all(text, ISSUE_REFERENCE, 0), issue_parts)


def issue_url(owner: Column, repo: Column, number: Column) -> Column:
    return F.concat(F.lit(FORGE_URL), owner, F.lit("/"), repo, F.lit("/issues/"), number.cast("string"))


def extract_titles(
    html: Column | str, site_name: str | None = None, patterns: Sequence[str] = TITLE_PATTERNS, longer_than: int = 10
) -> Column:
    """Candidate titles, all matches of the first pattern before those of the next."""
    found = F.transform(F.concat(*[find_all(html, p) for p in patterns]), trim_text)

    def keep(t: Column) -> Column:
        ok = utf16_length(t) > longer_than
        return ok if site_name is None else ok & ~F.contains(t, F.lit(site_name))

    return F.filter(found, keep)


def clean_title(title: Column | str, site_name: str | None = None) -> Column:
    """Drop a leading [label], a site suffix and everything after a pipe."""
    t = F.regexp_replace(col(title), rf"^{WHITESPACE}*\[{NOT_NEWLINE}*?\]{WHITESPACE}*", "")
    if site_name is not None:
        t = F.regexp_replace(t, rf"{WHITESPACE}*·{WHITESPACE}*\Q{site_name}\E{NOT_NEWLINE}*\z", "")
    t = F.regexp_replace(t, rf"{WHITESPACE}*\|{WHITESPACE}*{NOT_NEWLINE}*\z", "")
    return trim_text(t)


def drop_elements(html: Column | str, tags: Sequence[str]) -> Column:
    """Remove whole elements with their content."""
    out = col(html)
    for tag in tags:
        out = F.regexp_replace(out, rf"(?is)<{tag}\b.*?</{tag}>", "")
    return out


def html_to_markdown(html: Column | str, exclude_tags: Sequence[str] = ("script", "style")) -> Column:
    """Page text as markdown. Step order is part of the result and must stay as it is.

    Most steps have nothing to do on most pages, and a search for the tag in the lowered page tells so at a small
    part of the price of the pattern. No step makes a tag that a later one looks for.
    """

    def steps(page: Column) -> Column:
        out, has = page["html"], lambda tag: F.contains(page["lowered"], F.lit(tag))
        for tag, change in [*[(f"<{tag.lower()}", lambda t, tag=tag: drop_elements(t, [tag])) for tag in exclude_tags], *_heading_steps(), *_inline_steps()]:
            out = _when_there(out, has(tag), change)
        return F.regexp_replace(out, ANY_TAG, "")

    # (?i) finds ASCII letters of either case, as the lowered page has them.
    page = F.struct(col(html).alias("html"), F.lower(col(html)).alias("lowered"))
    plain = let(let(page, steps), lambda t: F.when(F.contains(t, F.lit("&")), _decoded(t)).otherwise(t))
    return trim_text(let(plain, lambda t: F.when(F.contains(t, F.lit("\n\n\n")), _fewer_blank_lines(t)).otherwise(t)))


def _when_there(text: Column, there: Column, change: Callable[[Column], Column]) -> Column:
    return let(text, lambda t: F.when(there, change(t)).otherwise(t))


def _heading_steps() -> list[tuple[str, Callable[[Column], Column]]]:
    def step(level: int) -> tuple[str, Callable[[Column], Column]]:
        return f"<h{level}", lambda t: F.regexp_replace(t, rf"(?i)<h{level}[^>]*>({NOT_NEWLINE}*?)</h{level}>", f"{'#' * level} $1\n")

    return [step(level) for level in range(1, 7)]


def _inline_steps() -> list[tuple[str, Callable[[Column], Column]]]:
    return [
        ("<a", lambda t: F.regexp_replace(t, rf'(?i)<a[^>]*href="([^"]*)"[^>]*>({NOT_NEWLINE}*?)</a>', "[$2]($1)")),
        ("<p", lambda t: F.regexp_replace(t, rf"(?i)<p[^>]*>({NOT_NEWLINE}*?)</p>", "$1\n\n")),
        ("<br", lambda t: F.regexp_replace(t, rf"(?i)<br{WHITESPACE}*/?>", "\n")),
    ]


def _decoded(text: Column) -> Column:
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def _fewer_blank_lines(text: Column) -> Column:
    return F.regexp_replace(text, r"\n{3,}", "\n\n")


def extract_links(html: Column | str) -> Column:
    """Non-blank link targets in page order."""
    return F.filter(find_all(html, LINK_HREF), lambda h: trim_text(h) != "")


def is_issue_link(link: Column) -> Column:
    return F.contains(link, F.lit("/issues/")) | F.contains(link, F.lit("/pull/"))


def forge_links(links: Column, forge: str = "github.com") -> Column:
    return F.filter(links, lambda h: F.contains(h, F.lit(forge)))


def prefer_issue_links(links: Column) -> Column:
    """Issue and pull-request links when there are any, else all links."""
    choose = lambda found, issues: F.when(F.size(issues) > 0, issues).otherwise(found)
    return let(links, lambda found: let(F.filter(found, is_issue_link), lambda issues: choose(found, issues)))


def display_name(text: Column | str) -> Column:
    """Page name from the title up to a dash, else the first heading, else an 'organization:' line."""
    # The three places, in order.
    places = (r"(?i)<title>([^-]+)", r"(?i)<h1[^>]*>([^<]+)", rf"(?i)organization:{WHITESPACE}*([^\n]+)")
    found = [F.nullif(F.regexp_extract(col(text), p, 1), F.lit("")) for p in places]
    return trim_text(F.coalesce(*found))


def item_count(text: Column | str) -> Column:
    """Number in front of the first count word that appears, 0 when none does."""
    # The four count patterns, in order.
    words = ("bounties?", "open", "active", "tasks?")
    return first_number(text, [rf"(?i)(\d+){WHITESPACE}*{w}" for w in words])


def first_number(text: Column | str, patterns: Sequence[str]) -> Column:
    found = [F.nullif(F.regexp_extract(col(text), p, 1), F.lit("")).try_cast("bigint") for p in patterns]
    return F.coalesce(*found, F.lit(0).cast("bigint"))


def count_terms(text: Column | str, terms: Sequence[str]) -> Column:
    """How many of the terms occur anywhere in the lower-cased text."""
    lowered = F.lower(col(text))
    hits = [F.contains(lowered, F.lit(t.lower())).cast("int") for t in terms]
    total = hits[0]
    for h in hits[1:]:
        total = total + h
    return total


# Words that mark a listing page.
LISTING_TERMS = (
    "bounties", "bounty", "reward", "task", "open", "completed",
    "GitHub", "repository", "issue", "pull request",
)


def is_listing_page(text: Column | str, terms: Sequence[str] = LISTING_TERMS, at_least: int = 3) -> Column:
    return count_terms(text, terms) >= at_least


def issue_title(*candidates: Column, number: Column) -> Column:
    """First non-empty title, else 'Issue #n'."""
    out = F.concat(F.lit("Issue #"), number.cast("string"))
    for c in reversed(candidates):
        out = text_or(c, out)
    return out


def plain_text(html: Column | str) -> Column:
    """Page text without any markup."""
    return trim_text(F.regexp_replace(drop_elements(html, ("script", "style")), ANY_TAG, " "))


def page_text(html: Column | str) -> Column:
    """Markdown, plain text and preferred forge links of a page, with blank lines between."""
    links = prefer_issue_links(forge_links(extract_links(html)))
    return F.concat_ws("\n\n", html_to_markdown(html), plain_text(html), F.array_join(links, "\n"))


def with_page_text(pages: DataFrame, html: str, text: str) -> DataFrame:
    """``pages`` with ``page_text`` of the column ``html`` in its place, as ``text``.

    The same steps in the same order, but each a projection of its own, which Spark compiles, and what markdown and plain text have in
    common is worked out once. A step is left out of a page that has nothing for it.
    """
    kept = [F.col(f"`{c}`") for c in pages.columns if c != html]
    out, low = F.col("_out"), F.col("_low")
    has = lambda tag: F.contains(low, F.lit(tag))
    changed = lambda there, change: F.when(there, change).otherwise(out).alias("_out")

    done = pages.select(*kept, F.col(html).alias("_out"), F.lower(html).alias("_low"))
    for tag in ("script", "style"):
        done = done.select(*kept, "_low", F.col("_page") if "_page" in done.columns else F.col("_out").alias("_page"), changed(has(f"<{tag}"), drop_elements(out, [tag])))
    links = F.when(has("<a"), F.array_join(prefer_issue_links(forge_links(extract_links("_page"))), "\n")).otherwise("")
    bare = F.when(F.contains(out, F.lit("<")), F.regexp_replace(out, ANY_TAG, " ")).otherwise(out)
    kept += [F.col("_links"), F.col("_plain")]
    done = done.select(*kept[:-2], "_low", "_out", links.alias("_links"), trim_text(bare).alias("_plain"))

    def headings(t: Column) -> Column:
        for tag, change in _heading_steps():
            t = _when_there(t, has(tag), change)
        return t

    for tag, change in [("<h", headings), *_inline_steps()]:
        done = done.select(*kept, "_low", changed(has(tag), change(out)))
    done = done.select(*kept, changed(F.contains(out, F.lit("<")), F.regexp_replace(out, ANY_TAG, "")))
    done = done.select(*kept, changed(F.contains(out, F.lit("&")), _decoded(out)))
    done = done.select(*kept, changed(F.contains(out, F.lit("\n\n\n")), _fewer_blank_lines(out)))
    return done.select(*kept[:-2], F.concat_ws("\n\n", trim_text(out), "_plain", "_links").alias(text))
