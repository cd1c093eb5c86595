"""Line differences: ranges and hunks. The matcher is the standard library's, one pair of texts at a time."""

from __future__ import annotations

import sys
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from siltmill.functions.values import by_value

RANGE = "old_start long, old_end long, new_start long, new_end long, n_inserts long, n_deletes long, n_changes long"


def _changes(base: list[str], head: list[str]) -> list[tuple[int, int, int, int]]:
    """Changed stretches: old from and to, new from and to."""
    return [(a, b, c, d) for kind, a, b, c, d in SequenceMatcher(None, base, head).get_opcodes() if kind != "equal"]


def range_of(base: str | None, head: str | None) -> tuple | None:
    """First and last changed lines on both sides and the numbers of inserted and deleted ones. Equal texts have the
    largest integer as starts and 0 as ends."""
    if base is None or head is None:
        return (None,) * 7
    found = _changes(base.splitlines(), head.splitlines())
    inserts, deletes = sum(d - c for *_, c, d in found), sum(b - a for a, b, *_ in found)
    old = (found[0][0], found[-1][1]) if found else (sys.maxsize, 0)
    new = (found[0][2], found[-1][3]) if found else (sys.maxsize, 0)
    return (*old, *new, inserts, deletes, inserts + deletes)


def change_range(base: Column, head: Column) -> Column:
    """struct RANGE of two texts, null throughout if one is null."""

    names = [c.split()[0] for c in RANGE.split(", ")]
    return by_value(lambda base, head: dict(zip(names, range_of(base, head))), pa.struct([(n, pa.int64()) for n in names]), RANGE)(base, head)


def hunks_of(base: str | None, head: str | None, first: int, context: int, mark: str) -> str | None:
    """Hunks from line `first` on, each behind mark and an @@ header; changes nearer than the context share one."""
    if base is None or head is None:
        return None
    old, new = base.splitlines()[first:], head.splitlines()[first:]
    groups: list[list[tuple[int, int, int, int]]] = []
    for change in _changes(old, new):
        if groups and change[0] - context <= groups[-1][-1][1]:
            groups[-1].append(change)
        else:
            groups.append([change])
    out, done = [], 0
    for k, group in enumerate(groups):
        ahead = max(min(context, group[0][0] - done), 0)
        room = (groups[k + 1][0][0] if k + 1 < len(groups) else len(old)) - group[-1][1]
        behind = max(min(context, room), 0)
        a, b = group[0][0] - ahead, group[-1][1] + behind
        c, d = group[0][2] - ahead, group[-1][3] + behind
        lines, at = [f"{mark}@@ -{a + 1},{b - a} +{c + 1},{d - c} @@"], a
        for lo, hi, new_lo, new_hi in group:
            lines += [" " + x for x in old[at:lo]] + ["-" + x for x in old[lo:hi]] + ["+" + x for x in new[new_lo:new_hi]]
            at = hi
        lines += [" " + x for x in old[at:b]]
        out.append("\n".join(lines))
        done = b
    return "\n".join(out)


def hunks(base: Column, head: Column, first: Column, context: int = 3, mark: str = "") -> Column:
    """The change from base to head as hunks, line numbers counted from `first`."""
    render = by_value(lambda base, head, first: hunks_of(base, head, int(first), context, mark), pa.string(), "string")
    return render(base, head, F.coalesce(first, F.lit(0)))
