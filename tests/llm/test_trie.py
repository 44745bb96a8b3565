"""The conversation trie against a plain one, and on awkward rows."""

import random
import sys
from pathlib import Path

import pytest

from gleanery.llm import trie

sys.path.insert(0, str(Path(__file__).resolve().parent))
import plain  # noqa: E402

SCHEMA = "conv_id long, turn long, role string, text string, conv string, pos int, depth int, ka long, held string"
EXTRA = ("x", 1, 2, 3, "y")


def given(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], r[1]))


def grown(n, turns, seed):
    """Conversations that share beginnings: some copies, some cut short, one long."""
    draw = random.Random(seed)
    rows = []
    for c in range(-3, n):
        same = c % 3 == 0  # a third of all conversations are one
        length = 37 if c == 4 else draw.randint(0, turns)
        rows += [(c, t, "user" if t % 2 else "assistant", f"é {t}" if same or draw.random() < 0.8 else f"other {draw.randint(0, 2)}") for t in range(turns if same else length)]
    return rows


@pytest.mark.parametrize("band, run", [(2, 3), (3, 1024), (16, 1024)])
def test_trie(spark, monkeypatch, band, run):
    monkeypatch.setattr(trie, "RUN", run)
    monkeypatch.setattr(trie, "FRAGMENT", 4)
    rows = grown(40, 9, band)
    turns = trie.turns_of(given(spark, rows))
    assert found(trie.prefix_trie(turns, turns.select("conv"), band)) == plain.trie(rows, splice=False)
    assert found(trie.prefix_trie(*trie.spliced(turns), band)) == plain.trie(rows)


def test_awkward_rows(spark):
    long = "word " * 50_000
    rows = [
        (0, None, None, None), (0, 1, "user", "a"), (0, 1, "user", "a"), (0, 1, "user", "b"),  # null turn, repeated row, tie
        (1, 0, "", ""), (1, 1, "user", "a"), (2, 0, None, None), (2, 5, "user", "a"),
        (7, 3, "user", long), (8, 2, "user", long), (9, 0, "us", "er|a"), (9, 1, "user", "|a"),  # the base of 7 to 9 isn't there
        (-1, 0, "user", "a"), (None, 0, "user", "lost"), (3, 0, "a", "b\x00c"),
    ]
    assert found(trie.op13(given(spark, rows))) == plain.trie(rows)
    assert found(trie.conversation_trie(given(spark, rows))) == plain.trie(rows, splice=False)
    assert trie.op13(given(spark, rows)).columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_no_rows(spark):
    for rows in ([], [(None, 0, "user", "a")]):
        assert found(trie.op13(given(spark, rows))) == []
