"""The three runs: full snapshot, incremental refresh and discovery."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.operators import changes, discovery, items, page_state, registry, stats
from gleanery.operators.keyed import settled


@dataclass(frozen=True)
class Snapshot:
    """Tables of one run, each a plan of its own."""

    items: DataFrame
    organizations: DataFrame
    as_of: Column
    version: str = "1.0.0"

    @property
    def totals(self) -> DataFrame:
        """One row: organizations, items and value. Items of failed organizations do not count."""
        return self.organizations.agg(
            F.count("*").alias("total_organizations"),
            F.sum("item_count").alias("total_items"),
            stats.money_sum("total_value_usd").alias("total_value_usd"),
        )

    @property
    def metadata(self) -> DataFrame:
        done = self.organizations.agg(
            F.try_divide(F.count_if("success").cast("double"), F.count("*")).alias("success_rate"),
            F.sum("duration_ms").alias("processing_time_ms"),
        )
        return done.select(
            F.lit(self.version).alias("version"), self.as_of.cast("timestamp").alias("generated_at"), "success_rate", "processing_time_ms"
        )

    def stats(self, full: bool = True) -> DataFrame:
        return stats.stats_report(self.items, self.organizations, self.as_of, full=full)

    def tables(self, full: bool = True, k: int = 10) -> dict[str, DataFrame]:
        """All that is published of a run, by name (see ``publish_snapshot``)."""
        return {
            "items": self.items, "organizations": self.organizations, "totals": self.totals, "metadata": self.metadata,
            "stats": self.stats(full), "top_organizations": stats.top_orgs(self.items, k),
        }


def build_snapshot(flat_items: DataFrame, outcomes: DataFrame, as_of: Column, version: str = "1.0.0") -> Snapshot:
    """Items and outcome rows of a run as a snapshot; ``nested_by_org`` and the writers publish it."""
    return Snapshot(flat_items, outcomes.withColumn("last_updated", as_of.cast("timestamp")), as_of, version)


def collect_items(
    orgs: DataFrame, pages: DataFrame, as_of: Column, listing: DataFrame | None = None, issues: DataFrame | None = None
) -> DataFrame:
    """Nested items of each organization from its best source.

    Order: listing API, then of all pages of the organization pre-extracted state, raw state and text; an issue
    counts once per organization. ``orgs`` holds handle, display_name, description and org_tech; ``pages``
    (handle, html, and page_id or url for their order) and ``listing`` (handle plus the listing row) bring
    the data. Pages whose text can't count are found first (``pages_of_best_source``, which runs jobs). Those that are
    left are scanned once and the HTML is dropped before any other join; what the pages of an organization served by the
    listing held is dropped after the scan.
    """
    details = orgs.select("handle", "display_name", "description", "org_tech")
    order = [c for c in ("page_id", "url") if c in pages.columns]
    read = items.pages_of_best_source(pages.select("handle", *order, "html"))
    found = items.organization_rows(items.best_source_rows(read), order)
    if listing is not None:
        served = listing.where("status = 'active'").select("handle").distinct()
        found = found.join(served, "handle", "left_anti")
    if issues is not None:
        known = issues.select(
            "owner", "repo", "number", F.col("title").alias("issue_title"), F.col("body").alias("issue_body"),
            F.col("html_url").alias("issue_html_url"), F.col("user").alias("issue_user"),
        )
        found = found.join(known, ["owner", "repo", "number"], "left")
    made = items.items_from_best_source(found.join(details, "handle"), as_of)
    if listing is None:
        return made
    return items.items_from_listing(listing.join(details, "handle"), as_of).unionByName(made)


@dataclass(frozen=True)
class Refresh:
    """Result of an incremental run."""

    checked: DataFrame
    state: DataFrame
    snapshot: DataFrame
    diff: DataFrame


def refresh(
    orgs: DataFrame, pages: DataFrame, state: DataFrame | None, previous: DataFrame, as_of: Column, url_template: str,
    force_all: bool = False, issues: DataFrame | None = None, **signature,
) -> Refresh:
    """Check the pages, extract those of changed organizations, and put their items into the last snapshot.

    ``orgs`` holds handle, url, display_name, description and org_tech; ``pages`` handle and html, with page_id or
    url for their order and error if there is one; ``previous`` flat items as ``flatten_items`` makes them.
    Every page is read once for its signature. The changed handles are settled, and only their pages are
    read again and extracted: the handles meet the pages below the extraction (``pages_of``), and no HTML is
    moved if the pages are a table bucketed by handle or few handles changed.
    """
    read = pages.select("handle", "html", *[c for c in ("error",) if c in pages.columns])
    signatures = page_state.handle_signatures(page_state.page_signatures(read, **signature))
    checked = settled(page_state.check_pages(orgs, signatures, state, as_of, url_template, force_all))
    changed = page_state.changed_handles(checked)
    todo = page_state.pages_of(pages, changed)
    fresh = items.flatten_items(collect_items(orgs, todo, as_of, issues=issues)).select(*previous.columns)
    return _replaced(checked, changed, previous, fresh)


def refresh_from_items(
    orgs: DataFrame, signatures: DataFrame, state: DataFrame | None, previous: DataFrame, fresh: DataFrame, as_of: Column,
    url_template: str, force_all: bool = False,
) -> Refresh:
    """The same from signatures and a ready table of items, of which the changed organizations' are taken."""
    checked = settled(page_state.check_pages(orgs, signatures, state, as_of, url_template, force_all))
    changed = page_state.changed_handles(checked)
    return _replaced(checked, changed, previous, fresh.join(changed, "handle", "left_semi"))


def _replaced(checked: DataFrame, changed: DataFrame, previous: DataFrame, fresh: DataFrame) -> Refresh:
    snapshot = settled(changes.replace_keys(previous, fresh, changed))
    fields = [f for f in changes.FIELDS if f in previous.columns]
    diff = changes.diff_snapshots(previous, snapshot, fields=fields, tags="tags" if "tags" in previous.columns else None)
    return Refresh(checked, page_state.next_state(checked), snapshot, diff)


def discover(
    known: DataFrame, sources: list[tuple[str, DataFrame]], facts: DataFrame, url_template: str, min_items: int = 1
) -> tuple[DataFrame, DataFrame]:
    """Merge handle sources, check them against page facts and grade them: (discovered, registry)."""
    merged = discovery.merge_handles(("existing", known), *sources)
    named = registry.registry_rows(merged, url_template).join(merged, "handle")
    found = discovery.validate_orgs(named.select("handle", "display_name", "discovery_method"), facts, min_items)
    return found, discovery.graded_registry(found, url_template)
