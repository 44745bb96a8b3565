"""Keyed page state over a stream of fetched pages."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from gleanery.functions.fingerprints import SIGNATURE_PATTERNS
from gleanery.operators.page_state import carry_last_changed, page_signatures

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = "handle STRING, checked_at TIMESTAMP, hash STRING, item_estimate BIGINT, first_seen BOOLEAN"
_RAW_OUTPUT = "handle STRING, at BIGINT, hash STRING, item_estimate BIGINT, first_seen BOOLEAN"


#: Checks of one handle and micro-batch that are held in memory; more go to the state store by time.
HELD = 10_000


class SignatureState(StatefulProcessor):
    """Keeps the last hash of a handle and passes on the checks that differ from it.

    At most ``held`` checks of a micro-batch are in memory: beyond that they stand in the state store by time and hash
    until they are read in that order, and memory has their times and hashes only.
    """

    def __init__(self, held: int = HELD) -> None:
        self.held = held

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "hash STRING, at BIGINT, changed_at BIGINT")
        self.waiting = handle.getMapState("waiting", "at BIGINT, hash STRING", "estimate BIGINT")

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.last.update((initialState.hash, initialState.at, initialState.changed_at))

    def _wait(self, checks: list[tuple]) -> None:
        for at, digest, estimate in checks:
            key = (at, digest)
            if not self.waiting.containsKey(key) or estimate < self.waiting.getValue(key)[0]:
                self.waiting.updateValue(key, (estimate,))

    def _in_order(self, rows: Iterator[Row]) -> Iterator[tuple]:
        checks, many = [], False
        for r in rows:
            checks.append((r.at, r.hash, r.item_estimate or 0))
            if len(checks) >= self.held:
                self._wait(checks)
                checks, many = [], True
        if not many:
            yield from sorted(checks)
            return
        self._wait(checks)
        for key in sorted(tuple(k) for k in self.waiting.keys()):
            yield (*key, self.waiting.getValue(key)[0])
        self.waiting.clear()

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.last.get() if self.last.exists() else None
        known, seen_at, changed_at = held if held is not None else (None, None, None)
        first = held is None
        # Failed fetches don't get here, so no field is missing.
        for at, digest, estimate in self._in_order(rows):
            if seen_at is not None and at < seen_at:
                continue  # an older check says nothing about the present state
            if first or digest != known:
                yield Row(handle=key[0], at=at, hash=digest, item_estimate=estimate, first_seen=first)
                known, changed_at, first = digest, at, False
            seen_at = at
        self.last.update((known, seen_at, changed_at))

    def close(self) -> None:
        pass


def stream_page_changes(
    pages: DataFrame, patterns: Sequence[str] = SIGNATURE_PATTERNS, ignore: Sequence[str] = (), mode: str = "counts",
    state: DataFrame | None = None, held: int = HELD,
) -> DataFrame:
    """Changed pages from a stream of (handle, checked_at, html); pages without html are failed fetches and say nothing.

    Signatures are made before the exchange, so only a short hash per page is shuffled and kept. ``state`` is stored
    page state (``read_state``): a stream that begins from it passes on only what has changed since, and nothing of a
    handle's checks before its stored one. Needs the RocksDB state store. Bound the rows per micro-batch with the
    source's trigger options.
    """
    signed = page_signatures(pages.select("handle", "checked_at", "html"), patterns, ignore, mode).where("hash IS NOT NULL")
    # Times cross into Python as whole microseconds, free of time zones.
    timed = signed.select("handle", F.unix_micros("checked_at").alias("at"), "hash", "item_estimate")
    known = None
    if state is not None:
        stored = state.where("hash IS NOT NULL").select("handle", "hash", F.unix_micros("last_checked").alias("at"), F.unix_micros("last_changed").alias("changed_at"))
        known = stored.groupBy("handle")
    found = timed.groupBy("handle").transformWithState(
        statefulProcessor=SignatureState(held), outputStructType=_RAW_OUTPUT, outputMode="Append", timeMode="None", initialState=known
    )
    return found.select("handle", F.timestamp_micros("at").alias("checked_at"), "hash", "item_estimate", "first_seen")


def batch_page_changes(history: DataFrame) -> DataFrame:
    """Batch twin over signed pages (handle, checked_at, hash, item_estimate): the same rows as the stream."""
    checks = carry_last_changed(history.where("hash IS NOT NULL"), "handle", "checked_at", "hash", ["hash", "item_estimate"])
    return checks.where("changed").select("handle", "checked_at", "hash", "item_estimate")
