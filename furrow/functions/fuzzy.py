"""Name similarity: normal forms, candidates and a matching ratio, in Arrow batches."""

from __future__ import annotations

import re
import unicodedata
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

MIN_SCORE, MIN_MARGIN, SURE, CONTAINED = 0.78, 0.04, 0.99, 0.88
BUCKETS = 48


def normal(name: str | None) -> str:
    return " ".join(unicodedata.normalize("NFKC", name or "").strip().lower().split())


def compact(name: str) -> str:
    return re.sub("[^a-z0-9]", "", name.lower())


def candidates(name: str | None) -> list[str]:
    """The whole name, its compact form, and the parts between slashes, brackets, commas and hyphens with theirs."""
    whole = normal(name)
    forms = [whole, compact(whole)]
    for part in re.split(r"[/(),\-]", whole):
        forms += [normal(part), compact(part)]
    return list(dict.fromkeys(f for f in forms if f))


def ratio(a: str, b: str, contained: int = 5) -> float:
    """1 if equal, 0.99 if equal in compact form, else the better matching ratio; containment is worth 0.88."""
    return _ratio(a, compact(a), b, compact(b), contained)


def _ratio(a: str, ca: str, b: str, cb: str, contained: int) -> float:
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    if ca and ca == cb:
        return SURE
    score = max(SequenceMatcher(None, a, b).ratio(), SequenceMatcher(None, ca, cb).ratio() if ca and cb else 0.0)
    short, long = sorted((ca, cb), key=len)
    return max(score, CONTAINED) if len(short) >= contained and short in long else score


def best_ratio(name: str | None, others: list[str] | None, contained: int = 5) -> float:
    """The best ratio of a candidate of name with one of others; the first that an alias (all but others' first) brings to 0.99 stands."""
    return _best([(c, compact(c)) for c in candidates(name)], [(o, compact(o)) for o in map(normal, others or [])], contained)


def _best(cands: list[tuple[str, str]], forms: list[tuple[str, str]], contained: int) -> float:
    best = 0.0
    for c in cands:
        for k, o in enumerate(forms):
            best = max(best, _ratio(*c, *o, contained))
            if k and best >= SURE:
                return best
    return best


def _bags(texts: list[str]) -> np.ndarray:
    """Characters of each text counted in BUCKETS."""
    out = np.zeros((len(texts), BUCKETS), dtype=np.int16)
    for k, t in enumerate(texts):
        for c in t:
            out[k, ord(c) % BUCKETS] += 1
    return out


class Lookup:
    """Names of entries, normalised once, with the bags of their characters.

    A matching ratio is at most twice the common characters over both lengths, so entries are scored in the order
    of that bound until no other can come among the best two.
    """

    def __init__(self, entries: list[tuple[str, list[str]]], contained: int = 5):
        self.contained = contained
        self.entries = [(i, [(n, compact(n)) for n in map(normal, names)]) for i, names in sorted(entries)]
        self.entries = [(i, forms) for i, forms in self.entries if forms]
        flat = [f for _, forms in self.entries for f in forms]
        self.first = np.cumsum([0] + [len(forms) for _, forms in self.entries])[:-1]
        self.bags = [_bags([f[k] for f in flat]) for k in (0, 1)]
        self.sizes = [np.array([len(f[k]) for f in flat]) for k in (0, 1)]

    def bounds(self, cands: list[tuple[str, str]]) -> np.ndarray:
        best = np.zeros(len(self.sizes[0]))
        for c in cands:
            for k in (0, 1):
                if not c[k]:
                    continue
                common = np.minimum(self.bags[k], _bags([c[k]])).sum(1)
                best = np.maximum(best, 2 * common / (len(c[k]) + self.sizes[k]))
                if k:
                    least = np.minimum(self.sizes[1], len(c[1]))
                    best = np.where((common == least) & (least >= self.contained), np.maximum(best, CONTAINED), best)
                    best = np.where((common == len(c[1])) & (self.sizes[1] == len(c[1])), 1.0, best)
        return np.maximum.reduceat(best, self.first) if len(best) else best

    def best_two(self, name: str | None) -> list[tuple[float, str]]:
        """(score, id) of the best entry and the second, ties to the smaller id."""
        cands = [(c, compact(c)) for c in candidates(name)]
        bound = self.bounds(cands)
        top: list[tuple[float, str]] = []
        for e in np.argsort(-bound, kind="stable").tolist():
            if len(top) == 2 and bound[e] < -top[1][0] - 1e-12:
                break
            ident, forms = self.entries[e]
            top = sorted([*top, (-_best(cands, forms, self.contained), ident)])[:2]
        return [(-score, ident) for score, ident in top]


@F.pandas_udf(StringType())
def normal_name(x: pd.Series) -> pd.Series:
    return x.map(normal)


@F.pandas_udf(ArrayType(StringType()))
def candidate_names(x: pd.Series) -> pd.Series:
    return x.map(candidates)
