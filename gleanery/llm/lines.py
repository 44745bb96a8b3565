"""Line dedup by site-relative frequency, in DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import free_name, settled

#: A line goes if it is on more than this share of its site's pages, and on so many pages at least.
RATIO = 0.3
LEAST_PAGES = 3
SALTS = 16

# Elements that are not shown, and elements that end a line.
UNSEEN = ("script", "style", "head", "noscript", "template")
BREAKS = (
    "address", "article", "aside", "blockquote", "body", "br", "dd", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "nav", "ol", "option", "p", "pre", "section", "table", "td", "th", "tr", "ul",
)
UNSEEN_PATTERN = "(?i)<!--.*?-->|" + "|".join(rf"<{t}\b[^>]*>.*?</{t}>" for t in UNSEEN)
BREAK_PATTERN = rf"(?i)</?({'|'.join(BREAKS)})\b[^>]*>"
# The same patterns and white space as Java finds them fastest: what all alternatives begin with comes first, and a lone blank is no match.
_UNSEEN = rf"(?i)<(?:!--.*?-->|({'|'.join(UNSEEN)})\b[^>]*>.*?</\1>)"
_BREAK = "(?i)</?(?:" + "|".join(f"{c}(?:{'|'.join(t[1:] for t in BREAKS if t[0] == c)})" for c in sorted({t[0] for t in BREAKS})) + r")\b[^>]*+>"
_SPACES = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"
HOST_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def visible_lines(html: str | Column) -> Column:
    """The lines that a page shows: white space in one piece, a line for each block, empty ones left out; null has none."""
    html = F.col(html) if isinstance(html, str) else html
    text = F.regexp_replace(F.coalesce(html, F.lit("")), _SPACES, " ")
    text = F.regexp_replace(text, _UNSEEN, " ")
    text = F.regexp_replace(F.regexp_replace(text, _BREAK, "\n"), "<[^>]*+>", "")
    # Blanks are put together in the whole text: none of them is a line's end.
    return F.filter(F.transform(F.split(F.regexp_replace(text, " {2,}", " "), "\n"), lambda x: F.trim(x)), lambda x: x != "")


def host(url: str | Column) -> Column:
    """Lower-case host of a URL; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit("")), HOST_PATTERN, 1))


def line_dedup(pages: DataFrame, lines: Column, site: Column, tie: str, ratio: float = RATIO, least: int = LEAST_PAGES) -> DataFrame:
    """All rows of ``pages`` with ``site``, ``n_lines``, ``n_dropped`` and ``kept_lines``, the lines that aren't boilerplate.

    A line is counted once for each page that has it, however often it stands there; a boilerplate line goes wherever it
    stands on its site's pages. Null sites are the site "". Pages without lines count as pages of their site. Repeated rows
    are pages of their own. An empty table gives an empty table.

    Lines are counted by their MD5, summed within each task first. What a site loses is one set per site, and small: with a
    mean of m lines to a page it has at most m / ratio members. That set meets the pages by site and a salt of ``tie``.
    """
    own, salt, gone = (free_name(pages, n) for n in ("_lines", "_salt", "_drops"))
    read = pages.drop("site", "n_lines", "n_dropped", "kept_lines").withColumn("site", F.coalesce(site, F.lit(""))).withColumn(own, lines)
    hashed = read.select("site", F.transform(F.array_distinct(own), lambda x: F.unhex(F.md5(x))).alias("l"))
    # A null stands for the page itself.
    counts = hashed.select("site", F.explode(F.concat(F.array(F.lit(None).cast("binary")), "l")).alias("line")).groupBy("site", "line").agg(F.count("*").alias("n"))
    counts = settled(counts.where(F.col("line").isNull() | (F.col("n") >= least)))
    totals = counts.where(F.col("line").isNull()).select("site", F.col("n").alias("pages"))
    often = counts.where(F.col("line").isNotNull())
    drops = often.join(totals, "site").where(F.col("n") > F.lit(ratio) * F.col("pages")).groupBy("site").agg(F.collect_list("line").alias(gone))
    salted = drops.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = read.withColumn(salt, F.pmod(F.xxhash64(tie), F.lit(SALTS)).cast("int")).join(salted, ["site", salt], "left")
    kept = F.when(F.col(gone).isNull(), F.col(own)).otherwise(F.filter(own, lambda x: ~F.array_contains(gone, F.unhex(F.md5(x)))))
    out = met.withColumn("kept_lines", kept)
    return out.select(
        *[F.col(f"`{c}`") for c in pages.columns if c not in ("site", "n_lines", "n_dropped", "kept_lines")], "site", F.size(own).cast("long").alias("n_lines"),
        (F.size(own) - F.size("kept_lines")).cast("long").alias("n_dropped"), "kept_lines",
    )


def op5(pages: DataFrame) -> DataFrame:
    """The lines of every page without its host's boilerplate."""
    found = line_dedup(pages.select("page_id", "url", "html"), visible_lines("html"), host("url"), "page_id")
    return found.select("page_id", F.col("site").alias("host"), "n_lines", "n_dropped", F.array_join("kept_lines", "\n").alias("text"))


OP5_SQL = rf"""
WITH shown AS (
  SELECT page_id, lower(regexp_extract(coalesce(url, ''), '{HOST_PATTERN}', 1)) AS host,
         regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '[\x20\x09-\x0D]+', ' ', 'g'), '{UNSEEN_PATTERN}', ' ', 'g'),
           '{BREAK_PATTERN}', chr(10), 'g'), '<[^>]*>', '', 'g') AS t
  FROM pages),
read AS (
  SELECT page_id, host, list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(regexp_replace(x, ' +', ' ', 'g'))), lambda x: x <> '') AS l FROM shown),
totals AS (SELECT host, count(*) AS pages FROM read GROUP BY host),
counts AS (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(l)) AS line FROM read) GROUP BY host, line),
drops AS (
  SELECT host, list(line) AS d FROM counts JOIN totals USING (host) WHERE n >= {LEAST_PAGES} AND n > {RATIO} * pages GROUP BY host),
kept AS (
  SELECT page_id, read.host AS host, l, CASE WHEN d IS NULL THEN l ELSE list_filter(l, lambda x: NOT list_contains(d, x)) END AS k
  FROM read LEFT JOIN drops ON read.host = drops.host)
SELECT page_id, host, len(l)::BIGINT AS n_lines, (len(l) - len(k))::BIGINT AS n_dropped, coalesce(array_to_string(k, chr(10)), '') AS text
FROM kept
"""
