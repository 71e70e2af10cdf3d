"""Tables whose cells span very many rows and columns: time and text stay in proportion to the page."""

import time

import numpy as np
import pytest

from gridjobs.llm import html_text


def by_columns(rows):
    """Where cells go, column by column."""
    held = {}
    for row in rows:
        at, out, new = 0, [], {}
        for _, span, down in row:
            while held.get(at, 0) > 0:
                at += 1
            out.append(at)
            for c in range(at, at + span):
                if down > 1 and held.get(c, 0) <= 0:
                    new[c] = down
            at += span
        held = {c: n - 1 for c, n in held.items() if n > 1}
        held |= {c: n - 1 for c, n in new.items() if c not in held or held[c] <= 0}
        yield out


@pytest.mark.parametrize("seed", range(30))
def test_cells_are_placed_as_column_by_column(seed):
    r = np.random.default_rng(seed)
    rows, ok = [], True
    held: dict[int, int] = {}
    for _ in range(25):  # cells that don't overlap: a span ends where a held column begins
        row, at, new = [], 0, {}
        for _ in range(int(r.integers(0, 6))):
            while held.get(at, 0) > 0:
                at += 1
            span, down = int(r.integers(1, 4)), int(r.integers(1, 5))
            while any(held.get(c, 0) > 0 for c in range(at, at + span)):
                span -= 1
            row.append((["x"], span, down))
            new |= dict.fromkeys(range(at, at + span), down)
            at += span
        held = {c: n - 1 for c, n in (held | new).items() if n > 1}
        rows.append(row)
    assert ok
    assert [[at for at, _, _ in row] for row in html_text.placed(rows)] == list(by_columns(rows))


@pytest.mark.parametrize("cell", ["<tr><td rowspan=9999 colspan=999>a", "<tr><td rowspan=0 colspan=999>a<td>b", "<tr><td rowspan=7 colspan=3>a<td rowspan=999>b"])
def test_many_spans(cell):
    page = "<table>" + cell * 10_000
    began = time.time()
    text = html_text.html_to_text(page)
    assert time.time() - began < 4
    assert len(text) < 10 * len(page)
    assert text.count("a") == 10_000


def test_a_long_cell_does_not_pad_every_row():
    page = "<table><tr><td>" + "long " * 20_000 + "<td>x" + "<tr><td>a<td>b" * 5_000
    text = html_text.html_to_text(page)
    assert len(text) < 10 * len(page)
    assert "a  b" in text
    small = html_text.html_to_text("<table><tr><td>name<td>n<tr><td>a<td>10<tr><td colspan=2>all<tr><td>b<td>7</table>")
    assert small.split("\n") == ["name  n", "a     10", "all", "b     7"]
