"""Benchmark decontamination by the q-gram lemma (operator 4).

A stretch of text within e edits of a passage of m characters shares at least
m + 1 - q - q * e of its q-grams with it, on diagonals at most e apart. So the
shared character q-grams of a document and a passage are counted in overlapping
bands of diagonals, bands that reach the bound are kept (those that overlap as one),
and all kept bands are verified side by side by a banded alignment of the whole
passage with the text around it. An alignment begins at the end of the passage that
shares less, and is given up as soon as its edits exceed the budget.

Passages of fewer than q characters are found as whole words without any edit.
Counting goes in slices and alignment in batches, so memory doesn't follow the
number of passages that share a stretch of text.

Texts and passages are compared in lower case with white space collapsed; start
and end are code points of that normal form.

Defined cases: null text counts as empty; null and blank passages and those with a
null id are left out. Equal passages are reported under each of their ids. Every
place is a row; of places of a passage that overlap, the one with the fewest edits,
then the first. Repeated documents each get their rows; other columns are ignored;
whole texts are read. Empty tables give no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm.common import chunks, codepoints, expand, lean, materialise, read_table, ship, texts

Q = 12
#: Edits allowed, as a share of a passage's characters.
EDIT_RATE = 0.06
#: Characters of passages indexed at once; more are searched in further passes.
BLOCK_CHARS = 8_000_000
#: Shared q-grams counted, and cells of alignments computed, at once.
POSTINGS, CELLS = 1_000_000, 2_000_000
_BITS = 24
_NONE = np.uint32(0xFFFFFFFF)


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def qgram_hashes(c: np.ndarray) -> np.ndarray:
    """Hashes of the 12 code points that start at each position."""
    if len(c) < Q:
        return np.zeros(0, np.uint64)
    c = c.astype(np.uint64)
    h2 = c[:-1] * np.uint64(0x9E3779B1) + c[1:]
    h4 = h2[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + h2[2:]
    h8 = h4[:-4] * np.uint64(0x165667B19E3779F9) + h4[4:]
    h = h8[:-4] * np.uint64(0xD6E8FEB86659FD93) + h4[8:]
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _word_hashes(c: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the size code points that start at each position."""
    n = max(len(c) - size + 1, 0)
    h = np.zeros(n, dtype=np.uint64)
    for k in range(size if n else 0):
        h = h * np.uint64(0x9E3779B97F4A7C15) + c[k : k + n]
    return h


def align(passages: list[np.ndarray], code: np.ndarray, first: np.ndarray, columns: int, low: np.ndarray, high: np.ndarray, budget: np.ndarray, backward: np.ndarray | None = None) -> np.ndarray:
    """Edits of each whole passage against the best stretch of its band, side by side: rows (edits, start, end), edits -1 if over budget.

    The band of passage i has so many columns: column k pairs its character j with code[first[i] + j + k].
    Nothing outside code[low[i] : high[i]] matches. With backward, passages that it marks are read from their
    ends and only edits are given.
    """
    n, k = len(passages), columns
    out = np.full((n, 3), -1, dtype=np.int64)
    size = np.array([len(p) for p in passages])
    order = np.argsort(size, kind="stable")  # the finished ones come first
    longest = int(size.max())
    chars = np.full((n, longest), _NONE, dtype=np.uint32)
    for row, i in enumerate(order):
        p = passages[i]
        chars[row, : len(p)] = p[::-1] if backward is not None and backward[i] else p
    steps = np.arange(k, dtype=np.int32)
    sign = np.ones(n, np.int64) if backward is None else np.where(backward[order], -1, 1)
    at = np.where(sign > 0, first[order], first[order] + size[order] + k - 2)
    size, low, high, budget, who = size[order], low[order], high[order], budget[order], order
    cost = np.zeros((n, k), dtype=np.int32)
    start = np.broadcast_to(steps, (n, k)).copy() if backward is None else None
    for j in range(longest + 1):
        done = int(np.searchsorted(size, j, side="right"))
        if done:
            end = cost[:done].argmin(1)
            edits = cost[np.arange(done), end]
            ok = edits <= budget[:done]
            out[who[:done][ok], 0] = edits[ok]
            if start is not None:
                out[who[:done][ok], 1] = at[:done][ok] + start[np.arange(done), end][ok]
                out[who[:done][ok], 2] = at[:done][ok] + size[:done][ok] + end[ok]
                start = start[done:]
            size, low, high, budget, who, cost, chars, at, sign = (x[done:] for x in (size, low, high, budget, who, cost, chars, at, sign))
        if not len(size):
            break
        place = at[:, None] + sign[:, None] * (j + steps)
        text = np.where((place >= low[:, None]) & (place < high[:, None]), code[np.clip(place, 0, len(code) - 1)], _NONE - np.uint32(1))
        new = cost + (text != chars[:, j, None])
        drop = cost[:, 1:] + 1 < new[:, :-1]
        new[:, :-1][drop] = cost[:, 1:][drop] + 1
        if start is not None:
            begin = start.copy()
            begin[:, :-1][drop] = start[:, 1:][drop]
        lead = new - steps
        np.minimum.accumulate(lead, axis=1, out=lead)  # insertions: the least of new[c] + (k - c) over c <= k
        if start is not None:
            src = np.maximum.accumulate(np.where(new - steps == lead, steps, 0), axis=1)
            start = np.take_along_axis(begin, src, 1)
        cost = lead + steps
        if j % 4 == 3:
            live = cost.min(1) <= budget
            if not live.all():
                size, low, high, budget, who, cost, chars, at, sign = (x[live] for x in (size, low, high, budget, who, cost, chars, at, sign))
                start = start[live] if start is not None else None
    return out


class Index:
    """q-grams of passages, sorted by hash, with a bitmap over the hashes' top bits."""

    def __init__(self, passages: list[tuple[int, str]]):
        ids = defaultdict(set)
        for item, text in passages:
            ids[normal(text)].add(item)
        every = sorted(t for t in ids if t)
        self.short = defaultdict(dict)  # by length: passage by hash
        for t in every:
            if len(t) < Q:
                self.short[len(t)].setdefault(int(_word_hashes(codepoints(t).astype(np.uint64), len(t))[0]), []).append(t)
        self.ids = {t: sorted(x) for t, x in ids.items()}
        self.texts = [t for t in every if len(t) >= Q]
        self.codes = [codepoints(t) for t in self.texts]
        size = np.array([len(c) for c in self.codes], dtype=np.int64)
        self.size, self.edits = size, np.minimum((EDIT_RATE * size).astype(np.int64), (size - Q) // Q)
        self.need, self.width = size + 1 - Q - Q * self.edits, self.edits + 1
        grams = [qgram_hashes(c) for c in self.codes]
        owner, off = expand(np.array([len(g) for g in grams], dtype=np.int64))
        h = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        h, self.owner, self.off = h[order], owner[order], off[order]
        self.hash, self.first, self.count = np.unique(h, return_index=True, return_counts=True)
        self.bits = np.zeros(1 << _BITS, dtype=bool)
        self.bits[(self.hash >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def _hits(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of code at which a known q-gram starts, and its number."""
        found = []
        for lo in range(0, len(code), 1 << 20):
            h = qgram_hashes(code[lo : lo + (1 << 20) + Q - 1])
            at = np.flatnonzero(self.bits[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
            k = np.searchsorted(self.hash, h[at])
            k[k == len(self.hash)] = 0
            ok = self.hash[k] == h[at]
            found.append((at[ok] + lo, k[ok]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _bands(self, at: np.ndarray, k: np.ndarray, base: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Bands of diagonals that reach the bound, merged where they overlap: (document, passage, first band, last band + 1, most of it in the passage's first half)."""
        n, shift = len(self.codes), int(self.size.max())
        wide = (int(base[-1]) + shift) // 1 + 2
        held = (np.zeros(0, np.int64), np.zeros((0, 2), np.int64))

        def kept(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
            following = np.zeros_like(counts)
            if len(keys) > 1:
                pair = np.flatnonzero(np.diff(keys) == 1)
                following[pair] = counts[pair + 1]
            both = counts + following
            ok = np.flatnonzero(both[:, 0] >= self.need[keys // wide % n])
            new = np.diff(keys[ok], prepend=-9) != 1
            heads = np.flatnonzero(new)
            first, last = keys[ok][heads], keys[ok][np.append(heads[1:], len(ok)) - 1] if len(heads) else keys[:0]
            share = both[ok][heads]
            return first // wide // n, first // wide % n, first % wide, last % wide + 2, 2 * share[:, 1] > share[:, 0]

        ends = np.cumsum(self.count[k])
        lo = 0
        while lo < len(at):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + POSTINGS, side="right")))
            who, nth = expand(self.count[k[lo:hi]])
            post, pos = self.first[k[lo:hi]][who] + nth, at[lo:hi][who]
            seg = self.owner[post]
            doc = np.searchsorted(base, pos, side="right") - 1
            key = (doc * n + seg) * wide + (pos - self.off[post] + shift) // self.width[seg]
            early = (2 * self.off[post] < self.size[seg]).astype(np.int64)
            keys, at_ = np.unique(key, return_inverse=True)
            counts = np.stack([np.bincount(at_, minlength=len(keys)), np.bincount(at_, weights=early, minlength=len(keys)).astype(np.int64)], 1)
            keys, at_ = np.unique(np.concatenate([held[0], keys]), return_inverse=True)
            both = np.zeros((len(keys), 2), dtype=np.int64)
            np.add.at(both, at_, np.concatenate([held[1], counts]))
            lo = hi
            if lo < len(at):  # documents before the next hit are complete
                cut = np.searchsorted(keys, (np.searchsorted(base, at[lo], side="right") - 1) * n * wide)
                held = keys[cut:], both[cut:]
                keys, both = keys[:cut], both[:cut]
            yield kept(keys, both)

    def search(self, items: list[str], all_places: bool = True) -> list[tuple[int, int, int, int, int]]:
        """(document, passage id, start, end, edits) of the places of passages in normal texts; without all_places any one of a text will do."""
        if not items or not self.ids:
            return []
        lens = np.array([len(x) for x in items], dtype=np.int64)
        base = np.concatenate([[0], np.cumsum(lens + 1)])
        code = codepoints("\n".join(items) + "\n")
        found: dict[tuple[int, str], list[tuple[int, int, int]]] = defaultdict(list)
        self._find_short(items, code, base, found)
        if self.codes:
            at, k = self._hits(code)
            for doc, seg, b0, b1, head in self._bands(at, k, base) if len(at) else ():
                if not all_places and found:
                    fresh = ~np.isin(doc, [d for d, _ in found])
                    doc, seg, b0, b1, head = (x[fresh] for x in (doc, seg, b0, b1, head))
                self._verify(code, base, doc, seg, b0, b1, head, found, all_places)
        out = []
        for (d, t), places in found.items():
            taken: list[tuple[int, int, int]] = []
            for edits, start, end in sorted(places):
                if all(end <= s or e <= start for _, s, e in taken):
                    taken.append((edits, start, end))
            out += [(d, i, s, e, x) for i in self.ids[t] for x, s, e in taken]
        return sorted(out)

    def _find_short(self, items: list[str], code: np.ndarray, base: np.ndarray, found: dict) -> None:
        for size, known in self.short.items():
            h = _word_hashes(code.astype(np.uint64), size)
            for p in np.flatnonzero(np.isin(h, np.array(list(known), dtype=np.uint64))).tolist():
                d = int(np.searchsorted(base, p, side="right")) - 1
                s, text = p - int(base[d]), items[d]
                if text[s : s + size] in known[int(h[p])] and not text[max(s - 1, 0) : s].isalnum() and not text[s + size : s + size + 1].isalnum():
                    found[d, text[s : s + size]].append((0, s, s + size))

    def _verify(self, code: np.ndarray, base: np.ndarray, doc: np.ndarray, seg: np.ndarray, b0: np.ndarray, b1: np.ndarray, head: np.ndarray, found: dict, all_places: bool) -> None:
        shift, edits = int(self.size.max()), self.edits[seg]
        first = b0 * self.width[seg] - shift - edits
        columns = (b1 - b0) * self.width[seg] + 2 * edits
        order = np.lexsort((self.size[seg], columns))
        lo = 0
        while lo < len(order):
            # columns differ by a sixth at most: shorter bands are made as wide as the widest of their batch
            hi = int(np.searchsorted(columns[order], columns[order[lo]] + columns[order[lo]] // 6, side="right"))
            hi = min(hi, lo + max(1, CELLS // int(columns[order[hi - 1]])))
            own, k = order[lo:hi], int(columns[order[hi - 1]])
            lo = hi
            a = ([self.codes[s] for s in seg[own]], first[own], base[doc[own]], base[doc[own] + 1] - 1, edits[own])
            good = align(a[0], code, a[1], k, a[2], a[3], a[4], head[own])[:, 0] >= 0
            if not good.any():
                continue
            if all_places:
                places = align([self.codes[s] for s in seg[own[good]]], code, a[1][good], k, a[2][good], a[3][good], a[4][good])
            else:
                places = np.stack([np.zeros(int(good.sum()), np.int64), a[2][good], a[2][good] + 1], 1)
            for d, s, (e, start, end) in zip(doc[own[good]].tolist(), seg[own[good]].tolist(), places.tolist(), strict=True):
                left, right = int(base[d]), int(base[d + 1]) - 1
                found[d, self.texts[s]].append((e, max(start, left) - left, min(end, right) - left))


SCHEMA = "doc_id bigint, item_id bigint, start int, end int, edits int"


def _finder(get):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(get())
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            items = [normal(t) for t in texts(b)]
            for lo, hi in chunks(items, 500_000):
                cols = list(zip(*((ids[lo + d], *x) for d, *x in index.search(items[lo:hi])), strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()), strict=True)], ["doc_id", "item_id", "start", "end", "edits"])

    return run


def passage_blocks(benchmark: DataFrame, size: int = BLOCK_CHARS) -> Iterator[tuple[Broadcast, bool]]:
    """The passages of benchmark (item_id, text) as (id, text) pairs, a block of about size characters at a time, and whether it is the only one.

    Of several blocks each is given up when the next one is asked for.
    """
    spark = benchmark.sparkSession
    ship(spark)
    bench = benchmark.where("text is not null and item_id is not null").select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    total = bench.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total) // size))
    for k in range(blocks):  # one, unless the passages are many
        own = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).distinct().collect()
        held = spark.sparkContext.broadcast(sorted((r.item_id, r.text) for r in own))
        yield held, blocks == 1
        if blocks > 1:
            held.destroy()


def find_passages(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Rows (doc_id, item_id, start, end, edits): passages of benchmark (item_id, text) that occur in docs (doc_id, text)."""
    out = None
    for held, only in passage_blocks(benchmark, block_chars):
        part = docs.select("doc_id", "text").mapInArrow(lean(_finder(lambda held=held: held.value)), SCHEMA)
        if not only:
            part = materialise(part, "passages")
        out = part if out is None else out.union(part)
    return out


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_passages(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
