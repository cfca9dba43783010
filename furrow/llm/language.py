"""Language identification of mixed-language text (operator 3).

Script ranges narrow the candidate languages of each word, hashed n-gram scores
rate the word under each candidate, and Viterbi with a switching penalty labels
spans of the whole text.

Defined cases: null or letterless text gives lang_pred 'und', score 0 and no
spans. Without any labelled row every document is 'und'. Ties go to the language
first in alphabetical order. Repeated rows each get their own result; columns
other than the id and the text are ignored. Very long texts are labelled whole:
their words are scored a piece at a time, pieces end between words. More than
MAX_LANGS languages are refused: the model is one table for every task.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm.common import chunks, codepoints, expand, fold, lean, maybe_broadcast, read_table, ship, texts

#: Script ranges (first and last code point): fixed values of the Unicode blocks.
SCRIPTS = [
    ("latin", 0x0041, 0x024F),
    ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul jamo", 0x1100, 0x11FF),
    ("latin additional", 0x1E00, 0x1EFF),
    ("greek extended", 0x1F00, 0x1FFF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
]
BUCKETS = 1 << 18
#: Labelled documents of a language from which its scores are learned, at most about so many.
SAMPLE_PER_LANG = 2000
#: Languages of a model, at most: it has BUCKETS numbers of four bytes for each.
MAX_LANGS = 256
#: A language is a candidate for a script that holds this share of its training letters.
MIN_SCRIPT_SHARE = 0.01
SWITCH_PENALTY = 12.0
VITERBI_CHARS = 3_000_000
#: Characters whose words are scored at once.
PIECE_CHARS = 500_000


class Model(NamedTuple):
    langs: list[str]
    weights: np.ndarray  # BUCKETS x languages: log probability of a feature, less that of the mean language
    allowed: np.ndarray  # scripts x languages
    prior: np.ndarray


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: 0 none, 1 letter, 2 mark; and its script, 0 if in no range."""
    import unicodedata

    n = sys.maxunicode + 1
    kind = np.fromiter((1 if (c := chr(i)).isalpha() else 2 if unicodedata.category(c)[0] == "M" else 0 for i in range(n)), np.uint8, n)
    script = np.zeros(n, dtype=np.uint8)
    for k, (_, lo, hi) in enumerate(SCRIPTS, 1):
        script[lo : hi + 1] = k
    return kind, script


class Words(NamedTuple):
    starts: np.ndarray  # in the code points of the chunk
    ends: np.ndarray
    doc: np.ndarray
    script: np.ndarray
    features: np.ndarray  # a row of buckets for each letter, by kind of n-gram
    at: np.ndarray  # the word's first row in features
    whole: np.ndarray  # the whole word's bucket


def words_of(items: list[str]) -> Words:
    """Words (letters with the marks that follow them) of a chunk of texts, and their hashed features."""
    kind, script = _tables()
    raw = codepoints("\n".join(items) + "\n")
    lens = np.fromiter(map(len, items), np.int64, len(items)) + 1
    inside = kind[raw] > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    keep = kind[raw[starts]] == 1 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[keep], ends[keep]
    low = codepoints("\n".join(x.lower() if len(x.lower()) == len(x) else "".join(c.lower() if len(c.lower()) == 1 else c for c in x) for x in items) + "\n")
    c = np.where(inside, low, 0).astype(np.uint32)
    pad = np.concatenate([[0], c, [0, 0]]).astype(np.uint32)
    a, b, d, e = pad[:-3], c, pad[2:-1], pad[3:]
    tri = (a * np.uint32(2654435761) + b * np.uint32(2246822519) + d * np.uint32(3266489917)) >> np.uint32(14)
    four = (a * np.uint32(668265263) + b * np.uint32(374761393) + d * np.uint32(2869860233) + np.where(d > 0, e, 0).astype(np.uint32) * np.uint32(3624381081)) >> np.uint32(14)
    size = ends - starts
    owner, off = expand(size)
    pos = starts[owner] + off
    powers = (np.arange(1, 65, dtype=np.uint32) * np.uint32(2654435769)) | np.uint32(1)
    at = np.cumsum(size) - size
    whole = np.add.reduceat(c[pos] * powers[off & 63], at).astype(np.uint32) if len(at) else np.zeros(0, np.uint32)
    whole = ((whole * np.uint32(2654435761)) ^ (whole >> np.uint32(15))) >> np.uint32(14)
    doc = np.searchsorted(np.cumsum(lens), starts, side="right")
    return Words(starts, ends, doc, script[raw[starts]], np.stack([tri[pos], four[pos]], 1), at, whole)


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feature counts of labelled texts: rows (lang, what, key, n)."""
    for b in batches:
        langs = np.array(b.column("lang").to_pylist(), dtype=object)
        items = texts(b)
        for lang in set(langs.tolist()):
            own = [items[i] for i in np.flatnonzero(langs == lang)]
            total, scripts = np.zeros(BUCKETS, np.int64), np.zeros(len(SCRIPTS) + 1, np.int64)
            for lo, hi in chunks(own):
                w = words_of(own[lo:hi])
                total += np.bincount(w.features.ravel(), minlength=BUCKETS) + np.bincount(w.whole, minlength=BUCKETS)
                scripts += np.bincount(w.script, weights=w.ends - w.starts, minlength=len(scripts)).astype(np.int64)
            for what, v in (("n", total), ("s", scripts)):
                key = np.flatnonzero(v)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key), pa.string()), pa.array([what] * len(key), pa.string()), pa.array(key.astype(np.int32)), pa.array(v[key])], ["lang", "what", "key", "n"])


def train(labelled: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Learn from labelled (doc_id, text, lang): about per_lang documents of each language at most, chosen by hash."""
    ship(labelled.sparkSession)
    labelled = labelled.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    sizes = labelled.groupBy("lang").count()
    known = [r.lang for r in sizes.select("lang").limit(MAX_LANGS + 1).collect()]
    if len(known) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    share = F.least(F.lit(1.0), F.lit(float(per_lang)) / F.col("count"))
    chosen = labelled.join(maybe_broadcast(sizes.select("lang", share.alias("share"))), "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.col("share") * (1 << 20))
    found = chosen.select("text", "lang").mapInArrow(lean(_counts), "lang string, what string, key int, n bigint").groupBy("lang", "what", "key").agg(F.sum("n").alias("n")).toArrow()  # MAX_LANGS times BUCKETS narrow rows at most
    langs = sorted(found.column("lang").unique().to_pylist())
    weights = np.full((BUCKETS, len(langs)), 0.5, dtype=np.float64)
    scripts = np.zeros((len(SCRIPTS) + 1, len(langs)))
    lang_of = pc.index_in(found.column("lang"), pa.array(langs, pa.string())).to_numpy().astype(np.int64)
    of_words = pc.equal(found.column("what"), "n").to_numpy()
    key, n = found.column("key").to_numpy(), found.column("n").to_numpy()
    for own, into in ((of_words, weights), (~of_words, scripts)):
        into[key[own], lang_of[own]] += n[own]
    if langs:
        seen = weights.sum(1) > 0.5 * len(langs) + 0.1
        weights = np.log(weights / weights.sum(0))
        weights -= weights.mean(1, keepdims=True)
        weights[~seen] = 0
    letters = scripts.sum(0)
    return Model(langs, weights.astype(np.float32), scripts >= MIN_SCRIPT_SHARE * np.maximum(letters, 1), letters / max(letters.sum(), 1))


def viterbi(scores: np.ndarray, first: np.ndarray, size: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each word: documents are rows first .. first+size of scores, labelled side by side."""
    label = np.zeros(len(scores), dtype=np.int16)
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    live = int((size > 0).sum())
    if not live:
        return label
    n_lang = scores.shape[1]
    best = scores[first[:live]].astype(np.float64)
    stay = np.ones((len(scores), n_lang), dtype=bool)
    came = np.zeros(len(scores), dtype=np.int16)
    last = np.zeros(live, dtype=np.int16)
    steps = int(size[0])
    alive = np.searchsorted(-size[:live], -np.arange(steps + 1), side="left")  # documents longer than t
    for t in range(1, steps):
        k = alive[t]
        if k < len(best):
            last[k : len(best)] = best[k:].argmax(1)
            best = best[:k]
        top = best.argmax(1)
        switch = best[np.arange(k), top] - penalty
        at = first[:k] + t
        keep = best >= switch[:, None]
        stay[at], came[at] = keep, top
        best = np.where(keep, best, switch[:, None]) + scores[at]
    last[: len(best)] = best.argmax(1)
    now = last.copy()
    for t in range(steps - 1, -1, -1):
        k = alive[t]
        at = first[:k] + t
        label[at] = now[:k]
        now[:k] = np.where(stay[at, now[:k]], now[:k], came[at])
    return label


def _score(w: Words, m: Model) -> np.ndarray:
    """Scores of words by language; a language whose scripts exclude the word is far below."""
    if not len(w.at):
        return np.zeros((0, len(m.langs)), np.float32)
    each = m.weights[w.features[:, 0]] + m.weights[w.features[:, 1]]
    out = np.add.reduceat(each, w.at, axis=0) + m.weights[w.whole]
    may = m.allowed[w.script]
    some = may.any(1, keepdims=True)
    return np.where(some, np.where(may, out, out - 1000), 0).astype(np.float32)


def labeller(get, penalty: float = SWITCH_PENALTY, spans: bool = True):
    """A mapInArrow function; get() gives the model."""

    def label(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = get()
        for b in batches:
            items, ids = texts(b), b.column("doc_id")
            for lo, hi in chunks(items, VITERBI_CHARS):
                yield _label(m, ids.slice(lo, hi - lo), items[lo:hi], penalty, spans)

    return label


SCHEMA = "doc_id bigint, lang_pred string, score double, n_spans int, spans array<struct<start:int,end:int,lang:string>>"


def _pieces(items: list[str], size: int) -> Iterator[tuple[list[int], list[int], list[str]]]:
    """Texts a few at a time, longer ones cut where no word goes on: (their numbers, where each begins, texts)."""
    kind, _ = _tables()
    for lo, hi in chunks(items, size):
        if hi - lo > 1 or len(items[lo]) <= size:
            yield list(range(lo, hi)), [0] * (hi - lo), items[lo:hi]
            continue
        text, at = items[lo], 0
        while at < len(text):
            end = min(at + size, len(text))
            while end < len(text) and kind[ord(text[end])]:  # on to the end of the word
                end += 1
            yield [lo], [at], [text[at:end]]
            at = end


def _label(m: Model, ids: pa.Array, items: list[str], penalty: float, with_spans: bool) -> pa.RecordBatch:
    n = len(items)
    parts, owners, starts, ends = [], [], [], []
    size = max(50_000, 4_000_000 // max(len(m.langs), 1))
    for numbers, begin, own in _pieces(items, min(size, PIECE_CHARS)):
        w = words_of(own)
        parts.append(_score(w, m))
        base = np.cumsum([0] + [len(x) + 1 for x in own])[:-1] - begin
        owners.append(np.array(numbers)[w.doc])
        starts.append(w.starts - base[w.doc])
        ends.append(w.ends - base[w.doc])
    scores = np.concatenate(parts) if parts else np.zeros((0, len(m.langs)), np.float32)
    doc = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    start = np.concatenate(starts) if starts else doc
    end = np.concatenate(ends) if ends else doc
    letters = np.bincount(doc, minlength=n)
    size_ = np.bincount(doc, minlength=n)
    first = np.cumsum(size_) - size_
    k = len(m.langs)
    if k:
        label = viterbi(scores, first, size_, penalty)
        weight = np.zeros((n, k))
        informed = scores.any(1)
        np.add.at(weight, (doc[informed], label[informed]), (end - start)[informed])
        total = weight.sum(1)
        best = np.where(total > 0, weight.argmax(1), int(m.prior.argmax()))
        share = np.where(total > 0, weight.max(1) / np.maximum(total, 1), m.prior[best])
    else:
        label = np.zeros(len(doc), np.int16)
        best, share = np.zeros(n, int), np.zeros(n)
    known = (letters > 0) & (k > 0)
    pred = [m.langs[i] if ok else "und" for i, ok in zip(best, known, strict=True)]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (label[1:] != label[:-1])
    heads = np.flatnonzero(new) if k else np.zeros(0, np.int64)
    tails = np.append(heads[1:], len(doc)) - 1 if len(heads) else heads
    n_spans = np.bincount(doc[heads], minlength=n) if len(heads) else np.zeros(n, np.int64)
    values = pa.StructArray.from_arrays([pa.array(start[heads].astype(np.int32)), pa.array(end[tails].astype(np.int32)), pa.array([m.langs[i] for i in label[heads]], pa.string())], ["start", "end", "lang"])
    offsets = np.concatenate([[0], np.cumsum(n_spans)]).astype(np.int32)
    spans = pa.ListArray.from_arrays(pa.array(offsets), values) if with_spans else pa.nulls(n, pa.list_(values.type))
    return pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(pred, pa.string()), pa.array(np.where(known, share, 0.0).astype(np.float64)), pa.array(n_spans.astype(np.int32)), spans], ["doc_id", "lang_pred", "score", "n_spans", "spans"])


def identify(docs: DataFrame, labelled: DataFrame, penalty: float = SWITCH_PENALTY, spans: bool = True) -> DataFrame:
    """Language of every document of docs (doc_id, text), learned from labelled (doc_id, text, lang).

    Returns doc_id, lang_pred, score (the share of letters in its spans), n_spans and spans.
    """
    model = train(labelled)
    held = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages floats
    return docs.select("doc_id", "text").mapInArrow(lean(labeller(lambda: held.value, penalty, spans)), SCHEMA)


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(fold(F.col("doc_id"), 3) != 1)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out: Column = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    found = identify(docs, training_rows(docs))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "n_spans", "spans")
