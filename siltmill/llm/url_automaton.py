"""URL filters as one bit-parallel wildcard automaton.

All glob rules are packed into one multiword Shift-And automaton: a bit per pattern position, a word per 64 bits. One
step on a character is a shift and two masks, for all patterns and all URLs of a batch at once.

Globs: `?` is any character but `/`, `*` any run without `/`, `**` any run. They match a whole canonical URL, which
is `.` + host + path, so that a glob like `*.example.net/en/**` takes the host and all its subdomains.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
RESULT = "host string, path string, rule string, verdict string"


@dataclass(frozen=True)
class UrlRule:
    """name is reported; of the named rules that match, the one with the longest name wins. Unnamed rules are the
    method's own: one of them blocks if no named rule matches."""

    glob: str
    verdict: str
    name: str | None = None


def site_rule(verdict: str, host: str, path: str) -> UrlRule:
    """A rule for a host with its subdomains and all paths that start with path."""
    return UrlRule(f"*.{host}{path}**", verdict, f"{host}{path}")


SITE_RULES = (
    site_rule("block", "net", "/"),
    site_rule("allow", "example.net", "/en/"),
    site_rule("block", "example.com", "/de/"),
    site_rule("allow", "org", "/fr/"),
)
#: Words that name a host's business; they stand in a host only.
OWN_RULES = tuple(UrlRule(f"*{x}**", "block") for x in ("spam", "casino", "-pills", ".ads-", ".ads.", "porn", "poker", "viagra"))
RULES = (*SITE_RULES, *OWN_RULES)


def canonical(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for a null or a URL without ://."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    for end in "?#":
        rest = rest.partition(end)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


class GlobAutomaton:
    """States of all globs side by side; bit k of a glob means that its first k symbols are matched."""

    def __init__(self, globs: Sequence[str]):
        steps, starts, finals, loops, at = [], [], [], [], 0
        for glob in globs:
            starts.append(at)
            i = 0
            while i < len(glob):
                if glob[i] == "*":
                    wide = glob[i : i + 2] == "**"
                    loops.append((at, wide))
                    i += 1 + wide
                else:
                    at += 1
                    steps.append((at, glob[i]))
                    i += 1
            finals.append(at)
            at += 1
        self.finals = np.array(finals, dtype=np.int64)
        self.words = at // 64 + 1
        self.alphabet = np.array(sorted({ord(c) for _, c in steps if c != "?"} | {ord("/")}), dtype=np.uint32)
        n = len(self.alphabet) + 1  # the last class is every other character
        slash = int(np.searchsorted(self.alphabet, ord("/")))
        self.take, self.stay = np.zeros((n, self.words), np.uint64), np.zeros((n, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        for bit in starts:
            self._set(self.start, bit)
        for bit, c in steps:
            for k in range(n) if c == "?" else [int(np.searchsorted(self.alphabet, ord(c)))]:
                if c != "?" or k != slash:
                    self._set(self.take[k], bit)
        for bit, wide in loops:
            for k in range(n):
                if wide or k != slash:
                    self._set(self.stay[k], bit)

    @staticmethod
    def _set(row: np.ndarray, bit: int) -> None:
        row[bit // 64] |= np.uint64(1 << (bit % 64))

    def match(self, subjects: Sequence[str]) -> np.ndarray:
        """Boolean matrix, subjects by globs. Longer subjects stand first, so each step touches those still running."""
        sizes = np.array([len(s) for s in subjects], dtype=np.int64)
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if len(sizes) else sizes
        points = np.frombuffer("".join(subjects[i] for i in order).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        codes = np.where(self.alphabet[at] == points, at, len(self.alphabet))
        state = np.repeat(self.start[None, :], len(sizes), axis=0)
        one, top = np.uint64(1), np.uint64(63)
        for pos in range(int(sizes[0]) if len(sizes) else 0):
            live = int(np.searchsorted(-sizes, -pos, side="left"))  # those longer than pos
            c, now = codes[starts[:live] + pos], state[:live]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:live] = (moved & self.take[c]) | (now & self.stay[c])
        hit = (state[:, self.finals // 64] >> (self.finals % 64).astype(np.uint64)) & one
        out = np.empty(hit.shape, dtype=bool)
        out[order] = hit == one
        return out


def judge(urls: Sequence[str | None], rules: Sequence[UrlRule], automaton: GlobAutomaton) -> pd.DataFrame:
    parts = [canonical(u) for u in urls]
    hits = automaton.match(["." + h + p if h or p else "" for h, p in parts])
    named = sorted((i for i, r in enumerate(rules) if r.name is not None), key=lambda i: -len(rules[i].name))
    own = [i for i, r in enumerate(rules) if r.name is None and r.verdict == "block"]
    rule, verdict = np.full(len(parts), None, object), np.where(hits[:, own].any(axis=1), "block", "allow").astype(object)
    free = np.ones(len(parts), bool)
    for i in named:
        now = free & hits[:, i]
        rule[now], verdict[now] = rules[i].name, rules[i].verdict
        free &= ~now
    return pd.DataFrame({"host": [h for h, _ in parts], "path": [p for _, p in parts], "rule": rule, "verdict": verdict})


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: Sequence[UrlRule] = RULES) -> DataFrame:
    """id, host, path, rule, verdict of every row.

    A null URL or one without :// has an empty host and path, fits no rule and is allowed. Repeated rows give
    repeated rows; an empty table gives none; other columns are ignored, whatever their names.
    """
    rules = tuple(rules)
    automaton = GlobAutomaton([r.glob for r in rules])

    @F.pandas_udf(RESULT)
    def judged(urls: pd.Series) -> pd.DataFrame:
        return judge(list(urls), rules, automaton)

    return pages.select(F.col(id_col), judged(F.col(url_col)).alias("j")).select(id_col, "j.*")
