"""Units are coded all at once, as one by one."""

from __future__ import annotations

import numpy as np

from siltstone.llm import toxicity as t


def plain(part):
    """Classes of one piece between the marks of the ends it has."""
    codes = t._classes()[np.frombuffer(part.strip(t.CUT).encode("utf-32-le"), np.uint32)].tolist()
    return [62] * (part[:1] != t.CUT) + codes + [63] * (part[-1:] != t.CUT)


def test_pieces_are_coded_together_as_one_by_one():
    units = ["", "a", "né", "x9", "y" * 48, "z" * 49, "abc" * 60, "\U0001d49c" * 3, "中" * 97]
    parts = [p for u in units for p in t.pieces(u)]
    rows = t._coded(parts)
    assert [[c for c in row if c >= 0] for row in rows.tolist()] == [plain(p) for p in parts]
    assert t._coded([]).shape == (0, 2)


def test_pieces_are_coded_without_a_table_look_up_each(monkeypatch):
    calls, classes = [], t._classes
    monkeypatch.setattr(t, "_classes", lambda: calls.append(1) or classes())
    monkeypatch.setattr(t.np, "concatenate", None)
    assert len(t._coded([f"word{i}" for i in range(3000)])) == 3000 and len(calls) == 1


def test_a_unit_has_the_greatest_margin_of_its_pieces():
    table = np.random.default_rng(3).normal(size=1 << 6 * t.ORDER).astype(np.float32)
    units = ["short", "q" * 30 + "rst" * 40, "", "an" * 26]
    each = [max(t.margins([u], table, 0.5)) for u in units]
    assert np.array_equal(t.margins(units, table, 0.5), each)
