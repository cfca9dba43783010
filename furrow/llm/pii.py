"""Personal data (operator 2): fixed patterns, and a linear-chain CRF over word shapes.

The patterns give the base spans. The CRF labels every word of every text and adds
spans that the patterns can't see: telephone numbers in other forms, spelled-out
addresses, secrets, document numbers, names after a title or a cue, and street
addresses. It is trained here from a small labelled table (pii_sentences.tsv, whose
slots are filled at random) by gradient ascent on the log likelihood, and decoded by
Viterbi over batches of texts in numpy. Texts of more than SEQUENCE words are decoded
in pieces; each ends at the word that is surest to stand outside of any span.

Defined cases: null text counts as empty; an empty text has no spans and the
hash of the empty string. Base spans of different kinds may overlap; an added
span that touches a base span or an earlier added one is dropped; of equally
likely labels the first in order is taken. Repeated rows each get their row; other
columns are ignored; whole texts are read, in time linear in their length.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from furrow.llm.common import chunks, expand, lean, read_table, ship, texts

FOUND = ("phone", "email", "secret", "id", "name", "address")
KINDS = ("email", "ip", "card", "phone", "secret", "id", "name", "address")
LABELS = ["O", *(f"{p}-{k}" for k in FOUND for p in "BI")]
#: Words whose features count for a word's label: two before it to two after it.
REACH = 2
#: Words decoded as one sequence, at most.
SEQUENCE = 1000
#: Sentences made of each line of the labelled table.
FILLS = 6

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]")
# A match can only begin where a run of digits begins, so the look-behind and the possessive
# repeats find what [0-9]+(\.[0-9]+){3} finds, in linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]")
_DIGIT = re.compile(r"[^0-9]")
_TRIGGER = re.compile(r"[0-9@]|[(\[]\s?(?:at|dot|punkt|arroba|punto|point)\s?[)\]]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"\S+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """What [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+ finds: each at sign with the local part before it."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL_END.match(text, start - 1):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            end = found.end()
        else:
            end = max(end, at + 1)
        at = text.find("@", max(end, at + 1))
    return out


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by kind and then start."""
    out: list[Span] = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) < 4 and int(p or 0) <= 255 for p in parts):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _NO_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


class _Shapes(dict):
    """Upper-case letters as A, other letters as a, digits as 0, the rest as it is."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = out = "0" if c.isdecimal() else "A" if c.isupper() else "a" if c.isalpha() else c
        return out


_SHAPES = _Shapes()
_RUN5, _RUN = re.compile(r"(.)\1{4,}", re.S), re.compile(r"(.)\1+", re.S)


def shape(word: str) -> str:
    """Kind of each character, runs longer than four cut to four."""
    return _RUN5.sub(r"\1\1\1\1", word.translate(_SHAPES))


_EDGES = ".,;:!?\"'()[]"


def shape_features(kinds: str) -> list[str]:
    """Features that the kinds of a word's characters tell."""
    cut = _RUN5.sub(r"\1\1\1\1", kinds) if len(kinds) > 4 else kinds
    core = kinds.strip(_EDGES) or kinds
    digits, n = kinds.count("0"), len(core)
    out = ["bias", "s=" + cut, "t=" + _RUN.sub(r"\1", cut), f"d={digits if digits < 12 else 12 if digits < 20 else 20}", f"n={n if n < 12 else 12 if n < 20 else 20}", "b=" + kinds[:1], "e=" + kinds[-1:]]
    return [*out, "mixed"] if digits and n > 15 and digits < n else out


def word_features(word: str) -> tuple[str, str, str]:
    """Features of its letters: the word itself, its first three and its last four."""
    low = word.lower()
    core = low.strip(_EDGES) or low
    return "w=" + core, "p=" + core[:3], "x=" + core[-4:]


def features(word: str) -> list[str]:
    return [*shape_features(word.translate(_SHAPES)), *word_features(word)]


def labelled_sentences(fills: int = FILLS, seed: int = 7, lines: Iterable[str] | None = None) -> list[tuple[list[str], list[str]]]:
    """Words and labels of the sentences that the labelled table gives when its slots are filled at random."""
    r = random.Random(seed)
    plain = "the and of to in is on we met for with that number page call name at dot key token der die und das mit von auf ist nicht ein et la les des que en est un una los del por con para".split()
    first = "Anna John Maria Peter Johann Claire Pedro Lucy Omar Ines Karl Sophie Tom Elena Hugo Greta Ivan Julia Marc Nora".split()
    last = "Schneider Smith Garcia Dubois Miller Baker Lopez Moreau Weber Jones Keller Martin Ruiz Fischer Brown Petit Novak Rossi King Hall".split()
    city = "London Berlin Madrid Paris Leeds Hamburg Sevilla Lyon Boston Zürich".split()

    def made(lo: int = 3, hi: int = 10) -> str:
        return "".join(r.choice("aeiourstnlhdmcgwépbñüèkçöíyvß") for _ in range(r.randint(lo, hi)))

    def some(known: list[str], cap: bool = True) -> str:
        x = r.choice(known) if r.random() < 0.5 else made()
        return x.capitalize() if cap else x.lower()

    def chars(alphabet: str, lo: int, hi: int) -> str:
        return "".join(r.choice(alphabet) for _ in range(r.randint(lo, hi)))

    digit, lower = "0123456789", "abcdefghijklmnopqrstuvwxyz"
    slots = {
        "w": lambda: r.choice(plain) if r.random() < 0.5 else made() + r.choice(["", "", "", ".", ","]),
        "W": lambda: made().capitalize() + r.choice(["", "", ",", "."]),
        "n": lambda: chars(digit, 1, 4),
        "first": lambda: some(first),
        "last": lambda: some(last),
        "city": lambda: some(city),
        "low": lambda: some(first + last, cap=False),
        "dom": lambda: r.choice(["mail", "gmail", "post", "web", made(4, 8)]),
        "hex": lambda: chars("0123456789abcdef", 24, 48),
        "b62": lambda: chars(digit + lower + lower.upper(), 20, 44),
        "pw": lambda: made(4, 8).capitalize() + chars(digit, 1, 4) + r.choice(["!", "", "$", "#"]),
        "UP": lambda: chars(digit + lower.upper(), 16, 16),
        "P": lambda: r.choice(lower.upper()),
        "rep": lambda: " ".join([r.choice([r.choice(plain), made(2, 8), made(2, 8).capitalize() + r.choice(["", "."])])] * r.randint(3, 9)),
        "CAPS": lambda: made(2, 9).upper() + r.choice(["", "", ".", ","]) + r.choice(["", "!!", "###", "%%%"]),
        "junk": lambda: made(3, 8) + r.choice(["!!", "###", "%%%", "***", "$$$", "&&&"]),
    }
    out = []
    for line in list(lines if lines is not None else table_lines()) * fills:
        words, labels = [], []
        for piece in re.findall(r"\[\[.*?\]\](?!\])|\S+", line):
            kind = None
            if piece.startswith("[["):
                kind, piece = piece[2:-2].split("|", 1)
            filled = re.sub(r"\{(\w+)\}", lambda m: slots[m[1]](), re.sub("#", lambda m: r.choice(digit), piece))
            own = filled.split()
            words += own
            labels += [f"B-{kind}"] + [f"I-{kind}"] * (len(own) - 1) if kind else ["O"] * len(own)
        if r.random() < 0.5:  # inside running text
            before, after = ([slots["w"]() for _ in range(r.randint(1, 4))] for _ in range(2))
            words, labels = before + words + after, ["O"] * len(before) + labels + ["O"] * len(after)
        out.append((words, labels))
    return out


def table_lines() -> list[str]:
    """The lines of the labelled table: [[kind|text]] marks a span, # is a digit, {name} a slot."""
    return [x for x in Path(__file__).with_name("pii_sentences.tsv").read_text(encoding="utf-8").split("\n") if x]


def viterbi(scores: np.ndarray, first: np.ndarray, size: np.ndarray, move: np.ndarray) -> np.ndarray:
    """The best label of each row of scores, in sequences of rows first .. first + size that are decoded side by side."""
    label = np.zeros(len(scores), dtype=np.int8)
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    live = int((size > 0).sum())
    if not live:
        return label
    back = np.zeros(scores.shape, dtype=np.int8)
    alive = np.searchsorted(-size[:live], -np.arange(int(size[0]) + 1), side="left")  # sequences longer than t
    best = scores[first[:live]]
    now = np.zeros(live, dtype=np.int64)
    for t in range(1, int(size[0])):
        k = alive[t]
        if k < len(best):
            now[k : len(best)] = best[k:].argmax(1)
        at = first[:k] + t
        step = best[:k, None, :] + move.T
        came = step.argmax(2)
        back[at] = came
        best = np.take_along_axis(step, came[:, :, None], 2)[:, :, 0] + scores[at]
    now[: len(best)] = best.argmax(1)
    for t in range(int(size[0]) - 1, -1, -1):
        k = alive[t]
        at = first[:k] + t
        label[at] = now[:k]
        now[:k] = back[at, now[:k]]
    return label


class CRF:
    """Weights of the features of a word and of its neighbours (by place, feature and label), of moves between labels, and of a word that repeats the one before."""

    def __init__(self, index: dict[str, int], emit: np.ndarray, move: np.ndarray, again: np.ndarray):
        self.index, self.emit, self.move, self.again = index, emit.astype(np.float32), move.astype(np.float32), again.astype(np.float32)

    def known(self, word: str, shapes: dict[str, tuple[int, ...]]) -> tuple[int, ...]:
        """Numbers of the features of a word that have weights; shapes remembers those of short kinds."""
        index, kinds = self.index, word.translate(_SHAPES)
        own = shapes.get(kinds)
        if own is None:
            own = tuple([index[f] for f in shape_features(kinds) if f in index])
            if len(kinds) < 40:
                shapes[kinds] = own
        more = tuple([index[f] for f in word_features(word) if f in index])
        return own + more if more else own

    def rows(self, found: list[tuple[int, ...]]) -> np.ndarray:
        """What words with these features add to the scores of labels around them: words x places x labels."""
        own = [x or (len(self.index),) for x in found]
        size = np.fromiter(map(len, own), np.int64, len(own))
        flat = np.fromiter(chain.from_iterable(own), np.int64, int(size.sum()))
        return np.stack([np.add.reduceat(e[flat], np.cumsum(size) - size) for e in self.emit], 1)

    def memory(self) -> Memory:
        return Memory(self)

    def scores(self, texts_of_words: list[list[str]], memory: Memory) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the labels of all words, and the number of words of each text."""
        size = np.fromiter(map(len, texts_of_words), np.int64, len(texts_of_words))
        ids, rows = memory.ids(chain.from_iterable(texts_of_words), int(size.sum()))
        _, nth = expand(size)
        left = np.repeat(size, size) - nth - 1  # words after it
        out = memory.table[rows, REACH]
        for d in range(1, REACH + 1):
            for place, ok, other in ((REACH - d, nth >= d, np.roll(rows, d)), (REACH + d, left >= d, np.roll(rows, -d))):
                out += memory.table[np.where(ok, other, 0), place]
        out[(nth > 0) & (ids == np.roll(ids, 1))] += self.again
        return out, size

    def decode(self, texts_of_words: list[list[str]], memory: Memory) -> list[np.ndarray]:
        """Best labels of the words of each text."""
        scores, size = self.scores(texts_of_words, memory)
        starts, sizes = [], []
        for at, n in zip((np.cumsum(size) - size).tolist(), size.tolist(), strict=True):
            while n > SEQUENCE:
                tail = scores[at + SEQUENCE - SEQUENCE // 10 : at + SEQUENCE]
                k = SEQUENCE - SEQUENCE // 10 + int((tail[:, 0] - tail[:, 1:].max(1)).argmax()) + 1
                starts.append(at)
                sizes.append(k)
                at, n = at + k, n - k
            starts.append(at)
            sizes.append(n)
        label = viterbi(scores, np.array(starts, dtype=np.int64), np.array(sizes, dtype=np.int64), self.move)
        return np.split(label, np.cumsum(size)[:-1]) if len(size) else []


class Memory(dict):
    """Numbers of words that were met, and a row for each set of features; emptied between texts when there are too many.

    Row 0 stands beyond a text's ends.
    """

    LIMIT = 300_000

    def __init__(self, crf: CRF):
        super().__init__()
        self.crf = crf
        self.empty()

    def empty(self) -> None:
        self.clear()
        self.table = self.crf.emit[:, self.crf.index["edge"]][None]
        self.sets: dict[tuple[int, ...], int] = {}
        self.row_of: list[int] = []
        self.fresh: list[tuple[int, ...]] = []
        self.shapes: dict[str, tuple[int, ...]] = {}

    def __missing__(self, word: str) -> int:
        own = self.crf.known(word, self.shapes)
        row = self.sets.get(own)
        if row is None:
            self.sets[own] = row = len(self.table) + len(self.fresh)
            self.fresh.append(own)
        self[word] = i = len(self.row_of)
        self.row_of.append(row)
        return i

    def ids(self, words: Iterable[str], n: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of words, and their rows of the table."""
        if len(self) > self.LIMIT:
            self.empty()
        out = np.fromiter(map(self.__getitem__, words), np.int64, n)
        if self.fresh:
            self.table = np.concatenate([self.table, self.crf.rows(self.fresh)])
            self.fresh = []
        return out, np.array(self.row_of, dtype=np.int64)[out] if n else out


def fit(data: list[tuple[list[str], list[str]]], rounds: int = 80, l2: float = 0.002, rate: float = 0.1) -> CRF:
    """Weights by Adam on the log likelihood: forward and backward sums of all sentences side by side, rescaled at each step."""
    own = {w: features(w) for words, _ in data for w in words}
    seen: dict[str, int] = {}
    for words, _ in data:
        for f in {f for w in words for f in own[w]}:
            seen[f] = seen.get(f, 0) + 1
    index = {f: i for i, f in enumerate(["edge", *sorted(f for f, n in seen.items() if n > 1)])}
    vocab = {w: i for i, w in enumerate(own, 1)}
    n, k, places = len(data), len(LABELS), 2 * REACH + 1
    size = np.array([len(w) for w, _ in data])
    longest = int(size.max())
    ids = np.zeros((n, longest + 2 * REACH), dtype=np.int64)  # 0 beyond the ends
    gold = np.zeros((n, longest, k))
    gold_move = np.zeros((k, k))
    for s, (words, labels) in enumerate(data):
        y = [LABELS.index(x) for x in labels]
        ids[s, REACH : REACH + len(words)] = [vocab[w] for w in words]
        gold[s, np.arange(len(y)), y] = 1
        np.add.at(gold_move, (y[:-1], y[1:]), 1)
    pairs = [(0, index["edge"])] + [(i, index[f]) for w, i in vocab.items() for f in own[w] if f in index]
    word_of, feature_of = (np.array(x) for x in zip(*pairs, strict=True))
    bounds = np.searchsorted(word_of, np.arange(len(vocab) + 1))
    by_feature = np.argsort(feature_of, kind="stable")
    feature_bounds = np.searchsorted(feature_of[by_feature], np.arange(len(index)))
    mask = np.arange(longest) < size[:, None]
    flat_ids = [np.where(mask, ids[:, j : j + longest], -1).ravel() for j in range(places)]
    orders = [np.argsort(x, kind="stable") for x in flat_ids]
    middle = ids[:, REACH : REACH + longest]
    again = (middle == ids[:, REACH - 1 : REACH - 1 + longest]) & mask
    theta = [np.zeros((places, len(index), k)), np.zeros((k, k)), np.zeros(k)]
    m, v = [np.zeros_like(x) for x in theta], [np.zeros_like(x) for x in theta]
    for it in range(1, rounds + 1):
        emit, move, twice = theta
        rows = np.stack([np.add.reduceat(e[feature_of], bounds) for e in emit])
        e = sum(rows[j][ids[:, j : j + longest]] for j in range(places)) + again[:, :, None] * twice
        e = np.exp(np.clip(e - e.max(2, keepdims=True), -60, 0))
        a = np.exp(np.clip(move, -30, 30))
        f, b = np.zeros((n, longest, k)), np.ones((n, longest, k))
        f[:, 0] = e[:, 0] / e[:, 0].sum(1, keepdims=True)
        for t in range(1, longest):
            x = f[:, t - 1] @ a * e[:, t]
            f[:, t] = np.where(mask[:, t, None], x / x.sum(1, keepdims=True), f[:, t - 1])
        pair = np.zeros((k, k))
        for t in range(longest - 2, -1, -1):
            y = e[:, t + 1] * b[:, t + 1]
            x = y @ a.T
            live = mask[:, t + 1, None]
            b[:, t] = np.where(live, x / x.sum(1, keepdims=True), 1.0)
            z = (f[:, t] * x).sum(1, keepdims=True)  # of both steps together
            pair += a * ((f[:, t] * live / z).T @ y)
        p = f * b
        p = p / p.sum(2, keepdims=True) * mask[:, :, None]
        g = ((gold - p) * mask[:, :, None]).reshape(-1, k)
        g_emit = np.zeros_like(emit)
        for j in range(places):
            ordered = flat_ids[j][orders[j]]
            at = np.searchsorted(ordered, np.arange(len(vocab) + 1))
            sums = np.concatenate([np.zeros((1, k)), np.cumsum(g[orders[j]], 0)])
            ends = np.append(at[1:], len(ordered))
            by_word = sums[ends] - sums[at]
            g_emit[j] = np.add.reduceat(by_word[word_of[by_feature]], feature_bounds)
        g_twice = g[again.ravel()].sum(0)
        for i, grad in enumerate((g_emit / n - l2 * emit, (gold_move - pair) / n - l2 * move, g_twice / n)):
            m[i] = 0.9 * m[i] + 0.1 * grad
            v[i] = 0.999 * v[i] + 0.001 * grad * grad
            theta[i] = theta[i] + rate * (m[i] / (1 - 0.9**it)) / (np.sqrt(v[i] / (1 - 0.999**it)) + 1e-8)
    emit = np.concatenate([theta[0], np.zeros((places, 1, k))], 1)  # a word without any known feature
    return CRF(index, emit, theta[1], theta[2])


@lru_cache(1)
def trained() -> CRF:
    return fit(labelled_sentences())


def crf_spans(items: list[str], crf: CRF, memory: Memory) -> list[list[Span]]:
    """Spans that the CRF finds in each text, trimmed of punctuation at their ends."""
    out: list[list[Span]] = []
    for text, labels in zip(items, crf.decode([t.split() for t in items], memory), strict=True):
        own: list[Span] = []
        out.append(own)
        marked = np.flatnonzero(labels)
        if not len(marked):
            continue
        places = [m.span() for m in _WORD.finditer(text)]
        t = 0
        while t < len(marked):
            u, name = t + 1, LABELS[labels[marked[t]]]
            while u < len(marked) and marked[u] == marked[u - 1] + 1 and LABELS[labels[marked[u]]] == f"I-{name[2:]}":
                u += 1
            s, e = places[marked[t]][0], places[marked[u - 1]][1]
            while e > s and text[e - 1] in ".,;:!?*%$&#|\"'":
                e -= 1
            while s < e and text[s] in "\"'|":
                s += 1
            if s < e:
                own.append((name[2:], s, e))
            t = u
    return out


def find(items: list[str], crf: CRF, memory: Memory | None = None) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    memory = memory or crf.memory()
    out = []
    for lo, hi in chunks(items):
        for text, more in zip(items[lo:hi], crf_spans(items[lo:hi], crf, memory), strict=True):
            own = base_spans(text)
            taken, extra = sorted((s, e) for _, s, e in own), []
            ends = np.maximum.accumulate([e for _, e in taken]) if taken else []
            last = 0
            for k, s, e in sorted(more, key=lambda x: (x[1], x[2])):
                at = int(np.searchsorted([a for a, _ in taken], e)) if taken else 0  # base spans that begin before its end
                if s >= last and not (at and ends[at - 1] > s):
                    extra.append((k, s, e))
                    last = e
            out.append((own, own + extra))
    return out


def mask(text: str, spans: list[Span]) -> str:
    """text with each span (overlapping ones together) replaced by its kind in angle brackets."""
    out, at = [], 0
    for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"<{k}>"]
        at = max(at, e)
    return "".join(out) + text[at:]


def detect(docs: DataFrame, masked: bool = True) -> DataFrame:
    """Counts, spans and (with masked) masked text of every document of docs (doc_id, text)."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(trained())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = held.value
        memory = crf.memory()
        for b in batches:
            items = texts(b)
            for lo, hi in chunks(items):
                part = items[lo:hi]
                found = find(part, crf, memory)
                ids = b.column("doc_id").slice(lo, len(part)).cast(pa.int64())
                counts = [pa.array([sum(k == kind for k, _, _ in own) for own, _ in found], pa.int64()) for kind in KINDS[:4]]
                sha = [hashlib.sha256(joined(own).encode()).hexdigest() for own, _ in found]
                more = [pa.array([mask(t, every) if every else t for t, (_, every) in zip(part, found, strict=True)], pa.string())] if masked else []
                yield pa.RecordBatch.from_arrays([ids, *counts, pa.array(sha, pa.string()), pa.array([joined(every) for _, every in found], pa.string()), *more], ["doc_id", *(f"n_{k}" for k in KINDS[:4]), "base_sha256", "spans", *["masked"] * masked])

    counts = ", ".join(f"n_{k} bigint" for k in KINDS[:4])
    return docs.select("doc_id", "text").mapInArrow(lean(run), f"doc_id bigint, {counts}, base_sha256 string, spans string" + ", masked string" * masked)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(read_table(spark, sf_dir, "documents"), masked=False)
