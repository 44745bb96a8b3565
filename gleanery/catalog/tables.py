"""The input roles (items, listings, pages, checks) derived from the given tables, in Spark and in SQL.

All derivations are row by row except the joins named in their docstrings, and none leaves rows out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

URL_TEMPLATE = "https://listings.example/{handle}/bounties?status=open"
AS_OF = "2001-09-01 00:00:00"


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz").cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# Orders as items: dollars between 10 and 5,000, tags from the priority words.
def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.round("o_totalprice").cast("bigint")
    return table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("id"),
        text("o_custkey").alias("handle"),
        F.concat(F.lit("Customer "), text("o_custkey")).alias("display_name"),
        F.concat(F.col("o_orderpriority"), F.lit(" item "), text("o_orderkey")).alias("title"),
        cents.alias("cents"),
        (cents / F.lit(100.0)).alias("amount_usd"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("difficulty"),
        F.split(F.lower("o_orderpriority"), "[- ]").alias("tags"),
        F.concat(F.lit("https://github.com/org"), text("o_custkey"), F.lit("/repo/issues/"), text("o_orderkey")).alias("url"),
        F.col("o_orderdate").alias("created_at"),
    )


ITEMS = """
items AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS handle,
    'Customer ' || o_custkey AS display_name, o_orderpriority || ' item ' || o_orderkey AS title,
    CAST(round(o_totalprice) AS BIGINT) AS cents, CAST(round(o_totalprice) AS BIGINT) / 100.0::DOUBLE AS amount_usd,
    o_orderstatus AS status, o_orderpriority AS difficulty,
    string_split_regex(lower(o_orderpriority), '[- ]') AS tags,
    'https://github.com/org' || o_custkey || '/repo/issues/' || o_orderkey AS url, o_orderdate AS created_at
  FROM orders
)"""


# Line items as items of a second snapshot of the same registry: ids repeat, organizations are suppliers.
def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.round("l_extendedprice").cast("bigint")
    key = F.concat(text("l_orderkey"), F.lit("#"), text("l_linenumber"))
    return table(spark, sf_dir, "lineitem").select(
        key.alias("id"),
        text("l_suppkey").alias("handle"),
        F.concat(F.lit("Item "), key).alias("title"),
        (cents / F.lit(100.0)).alias("amount_usd"),
        F.col("l_linestatus").alias("status"),
        F.concat(F.lit("https://github.com/o/r/issues/"), text("l_orderkey")).alias("url"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("difficulty"),
        F.array(F.lower("l_returnflag"), F.lower("l_linestatus")).alias("tags"),
        F.col("l_shipdate").alias("seen_at"),
        F.struct("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax").alias("tie"),
    )


def order_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.round("o_totalprice").cast("bigint")
    key = F.concat(text("o_orderkey"), F.lit("#1"))
    return table(spark, sf_dir, "orders").select(
        key.alias("id"),
        text("o_custkey").alias("handle"),
        F.concat(F.lit("Item "), key).alias("title"),
        (cents / F.lit(100.0)).alias("amount_usd"),
        F.col("o_orderstatus").alias("status"),
        F.concat(F.lit("https://github.com/o/r/issues/"), text("o_orderkey")).alias("url"),
        F.lit(None).cast("string").alias("difficulty"),
        F.array(F.lower("o_orderstatus")).alias("tags"),
        F.col("o_orderdate").alias("seen_at"),
    )


SNAPSHOTS = """
line_items AS (
  SELECT l_orderkey || '#' || l_linenumber AS id, CAST(l_suppkey AS VARCHAR) AS handle,
    'Item ' || l_orderkey || '#' || l_linenumber AS title, CAST(round(l_extendedprice) AS BIGINT) / 100.0::DOUBLE AS amount_usd,
    l_linestatus AS status, 'https://github.com/o/r/issues/' || l_orderkey AS url,
    CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS difficulty, [lower(l_returnflag), lower(l_linestatus)] AS tags,
    l_shipdate AS seen_at, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax
  FROM lineitem
),
order_heads AS (
  SELECT o_orderkey || '#1' AS id, CAST(o_custkey AS VARCHAR) AS handle, 'Item ' || o_orderkey || '#1' AS title,
    CAST(round(o_totalprice) AS BIGINT) / 100.0::DOUBLE AS amount_usd, o_orderstatus AS status,
    'https://github.com/o/r/issues/' || o_orderkey AS url, CAST(NULL AS VARCHAR) AS difficulty,
    [lower(o_orderstatus)] AS tags, o_orderdate AS seen_at
  FROM orders
),
last_lines AS (
  SELECT * FROM line_items QUALIFY row_number() OVER (
    PARTITION BY id ORDER BY seen_at DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
      l_discount DESC, l_tax DESC) = 1
)"""


# One listing page per order with one to four items, among them a repeated id and a zero amount.
REPOS = ("react-app", "zio-http", "django-kit", "tools", "vue-ui")
_PHRASES = (" fix api bug", " security review for rust", " update docs | more", " plain work")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, cust = F.col("o_orderkey"), text("o_custkey")
    cents = F.round("o_totalprice").cast("bigint")
    pick = lambda values, at: F.element_at(F.array(*[F.lit(v) for v in values]), at.cast("int"))
    repo = pick(REPOS, key % 5 + 1)

    def card(i):
        number = text(key * 10 + i)
        ident = text(key * 10 + F.when(i == 3, 0).otherwise(i))
        dollars = F.when(i == 2, "0").otherwise(F.format_number(F.floor(cents / (i + 1)) / F.lit(100.0), 2))
        title = F.concat(F.when(F.col("o_orderstatus") == "F", "[Bug] ").otherwise(""), "o_orderpriority", pick(_PHRASES, i + 1))
        return F.concat(
            F.lit('<div class="card" phx-value-id="b'), ident, F.lit('"><h3>Card '), number, F.lit("</h3>\n<a href=\"https://github.com/org"),
            cust, F.lit("/"), repo, F.lit("/issues/"), number, F.lit('">'), title, F.lit("</a>\n<p>Worth $"), dollars, F.lit("</p></div>"),
        )

    cards = F.array_join(F.transform(F.sequence(F.lit(0), (key % 4).cast("int")), card), "\n")
    return table(spark, sf_dir, "orders").select(
        key.alias("page_id"),
        cust.alias("handle"),
        F.concat(F.lit("https://listings.example/"), cust, F.lit("/bounties?page="), text(key)).alias("url"),
        F.concat(
            F.lit("<html><head><title>Listing - org"), cust, F.lit("</title></head><body><a href=\"/"), cust,
            F.lit("/bounties\">all</a>\n"), cards, F.lit("</body></html>"),
        ).alias("html"),
    )


LISTINGS = """
listings AS (
  SELECT o_orderkey AS page_id, CAST(o_custkey AS VARCHAR) AS handle,
    'https://listings.example/' || o_custkey || '/bounties?page=' || o_orderkey AS url,
    '<html><head><title>Listing - org' || o_custkey || '</title></head><body><a href="/' || o_custkey || '/bounties">all</a>' || chr(10)
    || array_to_string(list_transform(range(o_orderkey % 4 + 1), lambda i:
      '<div class="card" phx-value-id="b' || (o_orderkey * 10 + CASE WHEN i = 3 THEN 0 ELSE i END) || '"><h3>Card ' || (o_orderkey * 10 + i)
      || '</h3>' || chr(10) || '<a href="https://github.com/org' || o_custkey || '/'
      || (['react-app', 'zio-http', 'django-kit', 'tools', 'vue-ui'])[o_orderkey % 5 + 1] || '/issues/' || (o_orderkey * 10 + i) || '">'
      || CASE WHEN o_orderstatus = 'F' THEN '[Bug] ' ELSE '' END || o_orderpriority
      || ([' fix api bug', ' security review for rust', ' update docs | more', ' plain work'])[i + 1] || '</a>' || chr(10) || '<p>Worth $'
      || CASE WHEN i = 2 THEN '0' ELSE format('{:,.2f}', (CAST(round(o_totalprice) AS BIGINT) // (i + 1)) / 100.0::DOUBLE) END
      || '</p></div>'), chr(10)) || '</body></html>' AS html
  FROM orders
)"""


def page_checks(spark: SparkSession, sf_dir: str):
    """(registry, pages, state) for a page check: pages with '#top' fail, https pages are known, long ones stale."""
    pages = table(spark, sf_dir, "pages")
    registry = pages.select(text("page_id").alias("handle"), F.when(F.contains("url", F.lit("?")), "").otherwise(F.col("url")).alias("url"))
    failed = F.contains("url", F.lit("#top"))
    fetched = pages.select(
        text("page_id").alias("handle"),
        F.when(failed, "HTTP 503").alias("error"),
        F.when(~failed, F.col("html")).alias("html"),
    )
    return registry, fetched, pages


def page_check_state(signed: DataFrame) -> DataFrame:
    """Prior state: the present hash, except for French pages, of the pages served over https."""
    stale = F.contains("url", F.lit("/fr/"))
    return signed.where(F.startswith("url", F.lit("https:"))).select(
        text("page_id").alias("handle"), "url",
        F.when(stale, "stale").otherwise(F.col("hash")).alias("hash"),
        F.lit("2001-08-01 00:00:00").cast("timestamp").alias("last_checked"),
        F.lit("2001-07-01 00:00:00").cast("timestamp").alias("last_changed"),
        F.lit(7).cast("bigint").alias("item_estimate"),
    )


SIGNATURE = (r"(?i)the", r"\$\d+", r"(?i)on")
SIGNATURES = r"""
signed AS (
  SELECT page_id, url, html,
    substr(sha256(len(regexp_extract_all(html, '(?i)the')) || '-' || len(regexp_extract_all(html, '\$\d+')) || '-'
      || len(regexp_extract_all(html, '(?i)on'))
      || (length(html) + length(regexp_replace(html, '[^\x{10000}-\x{10FFFF}]', '', 'g')))), 1, 16) AS hash,
    CASE WHEN len(regexp_extract_all(html, '<nav>')) > 0 THEN len(regexp_extract_all(html, '<nav>'))
      ELSE len(regexp_extract_all(html, '\$\d+')) END AS item_estimate
  FROM pages
)"""


def parts_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sold parts as tagged items. Line items are counted per part before the join."""
    sold = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("sold"))
    parts = table(spark, sf_dir, "part")
    return sold.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        text("p_partkey").alias("id"),
        F.col("p_brand").alias("handle"),
        F.col("p_name").alias("title"),
        F.split(F.concat("p_name", F.lit(" "), "p_type"), " ").alias("tags"),
        (F.round(F.col("p_retailprice") * 100).cast("bigint") * F.col("sold") / F.lit(100.0)).alias("amount_usd"),
    )


PARTS_TAGGED = """
parts_tagged AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand AS handle, p_name AS title, string_split(p_name || ' ' || p_type, ' ') AS tags,
    CAST(round(p_retailprice * 100) AS BIGINT) * sold / 100.0::DOUBLE AS amount_usd
  FROM part JOIN (SELECT l_partkey, count(*) AS sold FROM lineitem GROUP BY 1) ON l_partkey = p_partkey
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + " "
