"""Declared schemas of everything read from files. Nothing is inferred."""

from __future__ import annotations

ORGANIZATION = (
    "handle STRING, id STRING, name STRING, description STRING, members ARRAY<VARIANT>, display_name STRING, "
    "created_at TIMESTAMP, website_url STRING, avatar_url STRING, discord_url STRING, slack_url STRING, "
    "stargazers_count BIGINT, twitter_url STRING, youtube_url STRING, tech ARRAY<STRING>, github_handle STRING, "
    "accepts_sponsorships BOOLEAN, days_until_timeout BIGINT, enabled_expert_recs BOOLEAN, "
    "enabled_private_bounties BOOLEAN"
)
TASK_SOURCE = (
    "data STRUCT<id: STRING, user: VARIANT, title: STRING, body: STRING, html_url: STRING>, type STRING"
)


def nested(fields: str) -> str:
    """STRUCT<...> from a column list."""
    out = []
    for part in _split(fields):
        name, kind = part.strip().split(" ", 1)
        out.append(f"{name}: {kind}")
    return f"STRUCT<{', '.join(out)}>"


def names(fields: str) -> list[str]:
    """Column names of a column list."""
    return [part.strip().split(" ", 1)[0] for part in _split(fields)]


def _split(fields: str) -> list[str]:
    parts, depth, start = [], 0, 0
    for i, ch in enumerate(fields):
        depth += (ch in "<(") - (ch in ">)")
        if ch == "," and depth == 0:
            parts.append(fields[start:i])
            start = i + 1
    return [*parts, fields[start:]]


TASK = (
    f"id STRING, status STRING, type STRING, number BIGINT, title STRING, source {nested(TASK_SOURCE)}, "
    "hash STRING, body STRING, url STRING, tech ARRAY<STRING>, repo_name STRING, repo_owner STRING, forge STRING"
)
REWARD = "currency STRING, amount BIGINT"
ITEM = (
    f"id STRING, status STRING, type STRING, kind STRING, org {nested(ORGANIZATION)}, updated_at TIMESTAMP, "
    "created_at TIMESTAMP, visibility STRING, autopay_disabled BOOLEAN, tech ARRAY<STRING>, bids ARRAY<VARIANT>, "
    "is_external BOOLEAN, manual_assignments BOOLEAN, point_reward BIGINT, "
    f"reward {nested(REWARD)}, reward_formatted STRING, reward_tiers ARRAY<VARIANT>, reward_type STRING, "
    f"task {nested(TASK)}, timeouts_disabled BOOLEAN"
)
ENVELOPE = (
    f"result STRUCT<data: STRUCT<json: STRUCT<items: ARRAY<{nested(ITEM + ', copies BIGINT')}>, next_cursor: STRING>>>"
)

REGISTRY_ROW = (
    "handle STRING, display_name STRING, url STRING, active BOOLEAN, scrape_interval BIGINT, tier STRING, "
    "description STRING, tech ARRAY<STRING>, last_scraped TIMESTAMP, error_count BIGINT, last_error STRING"
)
REGISTRY = f"updated_at TIMESTAMP, version STRING, organizations ARRAY<{nested(REGISTRY_ROW)}>"

FLAT_ITEM = (
    "id STRING, title STRING, amount_usd DOUBLE, amount_formatted STRING, status STRING, created_at TIMESTAMP, "
    "updated_at TIMESTAMP, url STRING, description STRING, tags ARRAY<STRING>, attempt_count BIGINT, "
    "difficulty STRING, repository STRUCT<owner: STRING, name: STRING, url: STRING>, issue_number BIGINT, copies BIGINT"
)
INDEX_ORG = (
    "display_name STRING, url STRING, bounty_count BIGINT, total_value_usd DOUBLE, last_updated TIMESTAMP, "
    f"scrape_duration_ms BIGINT, error STRING, bounties ARRAY<{nested(FLAT_ITEM)}>"
)
INDEX = (
    "generated_at TIMESTAMP, total_organizations BIGINT, total_bounties BIGINT, total_value_usd DOUBLE, "
    f"version STRING, organizations MAP<STRING, {nested(INDEX_ORG)}>"
)

INDEX_ROW = (
    "handle STRING, display_name STRING, item_count BIGINT, total_value_usd DOUBLE, part_no BIGINT, part_count BIGINT, "
    f"items ARRAY<{nested(FLAT_ITEM)}>, snapshot_date DATE"
)

PAGE_STATE = (
    "url STRING, hash STRING, last_checked TIMESTAMP, last_changed TIMESTAMP, bounty_count_estimate BIGINT"
)
STATE_DOCUMENT = f"version STRING, last_updated TIMESTAMP, organizations MAP<STRING, {nested(PAGE_STATE)}>"
STATE = (
    "handle STRING, url STRING, hash STRING, last_checked TIMESTAMP, last_changed TIMESTAMP, item_estimate BIGINT"
)

PAGES = "page_id BIGINT, url STRING, html STRING"
LISTING_ITEM = (
    "id STRING, status STRING, amount BIGINT, currency STRING, repo_owner STRING, repo_name STRING, "
    "created_at TIMESTAMP, updated_at TIMESTAMP, "
    "issue STRUCT<number: BIGINT, title: STRING, body: STRING, html_url: STRING, "
    "user: STRUCT<id: BIGINT, login: STRING, avatar_url: STRING, html_url: STRING>>"
)
LISTING = f"items ARRAY<{nested(LISTING_ITEM)}>"
ISSUES = "owner STRING, repo STRING, number BIGINT, title STRING, body STRING, html_url STRING, user VARIANT"
PROBES = "handle STRING, status INT, error STRING"
WEBHOOK = "watch_url STRING, timestamp TIMESTAMP, snapshot_id STRING"
RUN_LOG = (
    "timestamp TIMESTAMP, level STRING, message STRING, organization STRING, duration_ms BIGINT, error STRING, "
    "metadata VARIANT"
)
