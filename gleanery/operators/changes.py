"""Comparing two snapshots of items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.scalars import number_text
from gleanery.operators.keyed import checkpoint_dir, last_per_key
from gleanery.operators.scans import number_within

FIELDS = ("title", "amount_usd", "status", "url", "difficulty")


def _shown(c: Column) -> Column:
    return F.coalesce(c, F.lit("undefined"))


def _moved(label: str, old: Column, new: Column, quote: str = "", prefix: str = "") -> Column:
    side = lambda c: F.concat(F.lit(quote + prefix), _shown(c), F.lit(quote))
    return F.concat(F.lit(f"{label}: "), side(old), F.lit(" → "), side(new))


def field_changes(old: Column, new: Column, fields: Sequence[str] = FIELDS, tags: str | None = "tags") -> Column:
    """Readable differences of two item structs, in field order; empty when equal. NULL equals NULL."""

    def one(field: str) -> Column:
        a, b = old[field], new[field]
        if field == "title":
            text = _moved("title", a, b, quote='"')
        elif field == "amount_usd":
            text = _moved("amount", number_text(a), number_text(b), prefix="$")
        else:
            text = _moved(field, a.cast("string"), b.cast("string"))
        return F.when(~a.eqNullSafe(b), text)

    lines = [one(f) for f in fields]
    if tags is not None:
        none = F.array().cast("array<string>")
        before, after = F.coalesce(old[tags], none), F.coalesce(new[tags], none)
        for label, extra in (("tags added", F.array_except(after, before)), ("tags removed", F.array_except(before, after))):
            lines.append(F.when(F.size(extra) > 0, F.concat(F.lit(f"{label}: "), F.array_join(extra, ", "))))
    return F.array_compact(F.array(*lines))


def fields_differ(old: Column, new: Column, fields: Sequence[str] = FIELDS, tags: str | None = "tags") -> Column:
    """Whether ``field_changes`` would say anything."""
    out = F.lit(False)
    for f in fields:
        out = out | ~old[f].eqNullSafe(new[f])
    if tags is not None:
        none = F.array().cast("array<string>")
        before, after = F.coalesce(old[tags], none), F.coalesce(new[tags], none)
        moved = (F.size(F.array_except(after, before)) > 0) | (F.size(F.array_except(before, after)) > 0)
        out = out | (~before.eqNullSafe(after) & moved)
    return out


def diff_snapshots(
    prev: DataFrame,
    cur: DataFrame,
    key: str = "id",
    order: Sequence[str] | None = None,
    fields: Sequence[str] = FIELDS,
    tags: str | None = "tags",
) -> DataFrame:
    """Rows (change_type, key, old, new, changes) for added, removed and updated items.

    Both snapshots may repeat keys. With ``order``, current rows are compared with the last previous row
    of their key, and repeats stay in the result. A hot key is split by the join, as its rows sit on the
    left of a left and of an anti join whose right sides hold one row per key; whether there is one is found
    first (see ``has_hot_key``), as only then the right side is dealt out a second time for it. Without ``order``, rows
    have no time, and the two sides of a key are compared as multisets: rows that say the same cancel out,
    and what is left over is paired in the order of its content (see ``paired_rows``). No row is left out,
    and a snapshot compared with itself has no changes.
    """
    whole = lambda df: F.struct(*[F.col(c) for c in df.columns])
    old_side = lambda df: df.select(F.col(key), whole(df).alias("old"))
    new_side = lambda df: df.select(F.col(key), whole(df).alias("new"))
    old, new = F.col("old"), F.col("new")
    one_side = old.isNull() | new.isNull()
    texts = F.when(one_side, F.array().cast("array<string>")).otherwise(field_changes(old, new, fields, tags))
    kind = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("updated")
    finish = lambda df: (
        # Rows are chosen by plain comparisons; texts are made for the chosen ones only.
        df.where(one_side | fields_differ(old, new, fields, tags))
        .select(kind.alias("change_type"), key, "old", "new", texts.alias("changes"))
    )
    if order is None:
        return finish(paired_rows(prev, cur, key, fields, tags))
    if has_hot_key(cur, key):
        # Taken out of the row, the key is not that of the grouping, and Spark only divides a join whose two sides are dealt out for it.
        last = last_per_key(prev.withColumn("_of", F.col(key)), ["_of"], order).drop("_of")
    else:
        last = last_per_key(prev, [key], order)
    matched = new_side(cur).join(old_side(last), key, "left")
    removed = old_side(prev).join(cur.select(key).distinct(), key, "left_anti")
    return finish(matched).unionByName(
        removed.select(
            F.lit("removed").alias("change_type"), key, "old",
            F.lit(None).cast(matched.schema["new"].dataType).alias("new"),
            F.array().cast("array<string>").alias("changes"),
        )
    )


#: Rows of a key on one side that are numbered in one task; those of larger keys are numbered on sorted ranges.
HOT_KEY = 10_000
#: Keys with more rows that are sent to the readers.
SENT_KEYS = 100_000
#: Of all rows, so many in a hundred of one key are more than one task should join.
HOT_PERCENT = 1


def has_hot_key(df: DataFrame, key: str) -> bool:
    """Whether a key has more than ``HOT_KEY`` rows and ``HOT_PERCENT`` of all. This runs a job: a sketch of the most frequent keys, no key is moved."""
    # A sketch of 1,024 keys is off by less than a fifth of a percent of the rows.
    top, rows = df.agg(F.expr(f"approx_top_k(CAST(`{key}` AS STRING), 1, 1024)"), F.count("*")).first()
    return bool(top) and top[0]["count"] > max(HOT_KEY, rows * HOT_PERCENT / 100)


def _content(fields: Sequence[str], tags: str | None, row: str = "_row") -> list[Column]:
    """Two hashes of what ``field_changes`` compares."""
    parts = [F.col(row)[f] for f in fields]
    if tags is not None:
        parts.append(F.array_sort(F.array_distinct(F.coalesce(F.col(row)[tags], F.array().cast("array<string>")))))
    # A null hashes as nothing, so which fields are null counts as well.
    nulls = F.concat_ws("", *[F.when(F.col(row)[f].isNull(), "n").otherwise("v") for f in fields])
    return [F.xxhash64(*parts, nulls).alias("_h1"), F.xxhash64(nulls, *parts[::-1]).alias("_h2")]


def paired_rows(prev: DataFrame, cur: DataFrame, key: str, fields: Sequence[str] = FIELDS, tags: str | None = "tags") -> DataFrame:
    """(key, old, new): rows of two snapshots without an order, but those that say the same on both sides.

    As many rows of a key that say the same as both sides have cancel out, by hashes of the compared fields. What is left of a key is
    numbered on both sides by the compared fields and paired by number; rows without a partner stand alone. Keys that no side
    repeats are joined. Otherwise the rows are dealt out by key once, and all of a key's steps are done there; only keys
    with more than ``HOT_KEY`` rows on a side are numbered on sorted ranges, so a key with very many rows is split.
    """
    # Only the keys are read for this; those of one side are alone with their count.
    repeats = lambda df: df.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_n")).where("_n > 1 OR _k IS NULL")
    repeated = repeats(prev).unionByName(repeats(cur))
    any_, most = repeated.agg(F.count("*"), F.max("_n")).first()
    whole = lambda df: F.struct(*[F.col(c) for c in df.columns])
    if not any_:
        old, new = prev.select(F.col(key).alias("_key"), whole(prev).alias("old")), cur.select(F.col(key).alias("_key_new"), whole(cur).alias("new"))
        together = old.join(new, F.col("_key") == F.col("_key_new"), "full_outer").select(F.coalesce("_key", "_key_new").alias(key), "old", "new")
        return together.where(F.col("old").isNull() | F.col("new").isNull() | fields_differ(F.col("old"), F.col("new"), fields, tags))
    if most <= HOT_KEY:
        return _paired_by_key(prev, cur, key, fields, tags)
    checkpoint_dir(prev.sparkSession)
    hot = repeated.where(F.col("_n") > HOT_KEY).select("_k").distinct().checkpoint()
    hot = F.broadcast(hot) if hot.count() <= SENT_KEYS else hot
    part = lambda df, how: df.join(hot, F.col(key).eqNullSafe(F.col("_k")), how)
    others = _paired_by_key(part(prev, "left_anti"), part(cur, "left_anti"), key, fields, tags)
    return others.unionByName(_paired_on_ranges(part(prev, "left_semi"), part(cur, "left_semi"), key, fields, tags))


def _paired_by_key(prev: DataFrame, cur: DataFrame, key: str, fields: Sequence[str], tags: str | None) -> DataFrame:
    """``paired_rows`` of keys of bounded size."""
    struct = lambda df: F.struct(*[F.col(c) for c in df.columns])
    none = lambda df: F.lit(None).cast(df.schema)
    sides = prev.select(F.col(key).alias("_key"), struct(prev).alias("old"), none(cur).alias("new")).unionByName(
        cur.select(F.col(key).alias("_key"), none(prev).alias("old"), struct(cur).alias("new"))
    )
    is_old = F.col("old").isNotNull()
    hashes = [F.when(is_old, a).otherwise(b).alias(h) for h, a, b in zip(("_h1", "_h2"), _content(fields, tags, "old"), _content(fields, tags, "new"))]
    same = Window.partitionBy("_key", "_h1", "_h2")
    counted = sides.repartition("_key").select("*", is_old.alias("_is_old"), *hashes).withColumns({"_a": F.count("old").over(same), "_b": F.count("new").over(same)})
    # What is left of rows that say the same is of one side; its text settles which of them, if some cancel out.
    text = F.coalesce(F.to_json("old"), F.to_json("new"))
    left = counted.where((F.col("_a") != F.col("_b")) & ((F.col("_a") > F.col("_b")) == F.col("_is_old")))
    left = left.withColumn("_text", F.when(F.least("_a", "_b") > 0, text)).withColumn("_copy", F.row_number().over(same.orderBy("_text")))
    left = left.where((F.least("_a", "_b") == 0) | (F.col("_copy") <= F.abs(F.col("_a") - F.col("_b"))))
    said = [*fields, *([] if tags is None else [tags])]
    order = [F.col(side)[f] for side in ("old", "new") for f in said]
    placed = left.withColumn("_place", F.row_number().over(Window.partitionBy("_key", "_is_old").orderBy(*order, text)))
    together = placed.groupBy("_key", "_place").agg(F.first("old", ignorenulls=True).alias("old"), F.first("new", ignorenulls=True).alias("new"))
    return together.select(F.col("_key").alias(key), "old", "new")


def _paired_on_ranges(prev: DataFrame, cur: DataFrame, key: str, fields: Sequence[str], tags: str | None) -> DataFrame:
    """``paired_rows`` of keys of any size: counting is an aggregate with a map-side part, numbering is done on sorted ranges."""
    hashes = ["_h1", "_h2"]
    said = [*fields, *([] if tags is None else [tags])]
    sides = [df.select(F.col(key).alias("_key"), F.struct(*[F.col(c) for c in df.columns]).alias("_row")).select("*", *_content(fields, tags)) for df in (prev, cur)]
    counted = sides[0].select("_key", *hashes, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        sides[1].select("_key", *hashes, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    found = counted.groupBy("_key", *hashes).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b")).where("_a <> _b")
    more = lambda x, y: F.greatest(F.col(x) - F.col(y), F.lit(0))
    keys = found.groupBy(F.col("_key").alias("_k")).agg((F.greatest(F.sum(more("_a", "_b")), F.sum(more("_b", "_a"))) > 1).alias("_many"))
    checkpoint_dir(prev.sparkSession)
    left_over = found.join(keys, F.col("_key").eqNullSafe(F.col("_k"))).drop("_k").checkpoint()

    def numbered(side: DataFrame, own: str, other: str, name: str) -> DataFrame:
        mine = left_over.where(F.col(own) > F.col(other)).select(
            F.col("_key").alias("_of"), *[F.col(h).alias(f"{h}_of") for h in hashes], (F.col(own) - F.col(other)).alias("_more"), (F.col(other) > 0).alias("_some"), "_many"
        )
        same = F.col("_key").eqNullSafe(F.col("_of")) & (F.col("_h1") == F.col("_h1_of")) & (F.col("_h2") == F.col("_h2_of"))
        rows = side.join(mine, same).select("_key", "_row", *hashes, "_more", "_some", "_many")
        text = F.to_json("_row")  # settles which of several rows that say the same are left over
        kept = ["_key", "_row", "_many"]
        extra = number_within(rows.where("_some").withColumn("_text", text), ["_key", *hashes], ["_text"], "_copy").where("_copy <= _more")
        rows = rows.where("NOT _some").select(kept).unionByName(extra.select(kept))
        order = [F.struct(*[F.col(f"_row.{f}") for f in said]), text]
        placed = number_within(rows.where("_many"), ["_key"], order, "_place").unionByName(rows.where("NOT _many").withColumn("_place", F.lit(1).cast("bigint")))
        return placed.select("_key", "_place", F.col("_row").alias(name))

    old = numbered(sides[0], "_a", "_b", "old")
    new = numbered(sides[1], "_b", "_a", "new").withColumnsRenamed({"_key": "_key_new", "_place": "_place_new"})
    together = old.join(new, F.col("_key").eqNullSafe(F.col("_key_new")) & (F.col("_place") == F.col("_place_new")), "full_outer")
    return together.select(F.coalesce("_key", "_key_new").alias(key), "old", "new")


def diff_keys(prev: DataFrame, cur: DataFrame, key: str = "handle") -> DataFrame:
    """Keys on one side only, as (change_type, key)."""
    before = prev.select(key).distinct().withColumn("_before", F.lit(True))
    after = cur.select(key).distinct().withColumn("_after", F.lit(True))
    return (
        before.join(after, key, "full_outer")
        .where("_before IS NULL OR _after IS NULL")
        .select(F.when(F.col("_before").isNull(), "added").otherwise("removed").alias("change_type"), key)
    )


def diff_counts(items: DataFrame, orgs: DataFrame) -> DataFrame:
    """One row with the number of added, removed and updated items and of added and removed organizations."""
    tagged = items.select(F.col("change_type").alias("kind")).unionByName(
        orgs.select(F.concat(F.lit("org_"), "change_type").alias("kind"))
    )
    names = {"added": "added", "removed": "removed", "updated": "updated", "orgs_added": "org_added", "orgs_removed": "org_removed"}
    counts = tagged.agg(*[F.count_if(F.col("kind") == k).alias(n) for n, k in names.items()])
    any_change = sum((F.col(n) for n in list(names)[1:]), F.col("added")) > 0
    return counts.withColumn("has_changes", any_change).withColumn("summary", change_summary())


def change_summary(noun: str = "bounties") -> Column:
    """Sentence from the counter columns of ``diff_counts``."""
    part = lambda c, text: F.when(F.col(c) > 0, F.concat(F.col(c).cast("string"), F.lit(f" {text}")))
    parts = F.concat_ws(
        ", ",
        part("added", f"{noun} added"),
        part("removed", f"{noun} removed"),
        part("updated", f"{noun} updated"),
        part("orgs_added", "organizations added"),
        part("orgs_removed", "organizations removed"),
    )
    return F.when(parts == "", "No changes detected").otherwise(parts)


def initial_summary(cur: DataFrame, noun: str = "bounties") -> DataFrame:
    """Counters and sentence for a first snapshot."""
    counts = cur.agg(F.count("*").alias("added"), F.countDistinct("handle").alias("orgs_added"))
    text = F.concat(
        F.lit("Initial scan: "), F.col("added").cast("string"), F.lit(f" {noun} across "),
        F.col("orgs_added").cast("string"), F.lit(" organizations"),
    )
    return counts.withColumn("summary", text)


def replace_keys(snapshot: DataFrame, fresh: DataFrame, changed: DataFrame, key: str = "handle") -> DataFrame:
    """Snapshot with all items of the changed keys replaced by the fresh ones, which are of these keys only."""
    return snapshot.join(changed.select(key).distinct(), key, "left_anti").unionByName(fresh)


def apply_changes(snapshot: DataFrame, fresh: DataFrame, changed: DataFrame, key: str = "handle") -> DataFrame:
    """Snapshot with all items of the changed keys replaced by fresh ones; other keys are kept."""
    keys = changed.select(key).distinct()
    return replace_keys(snapshot, fresh.join(keys, key, "left_semi"), keys, key)
