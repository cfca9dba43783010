"""Toxicity by multiple-instance learning (operator 10).

A document is a bag of sentences. Each sentence gets a probability from its
words, noisy-or joins them to the document's, and only document labels train the
weights; the sentence probabilities then locate what offends.

Words count by themselves and by their prefixes. A feature enters the model when
the labelled sample shows that it goes with a class (MIN_Z deviations, MIN_DOCS
documents). Sentences of clean documents also get some probability, which would add
up in long texts. So beside the worst sentence, which counts in full, the sentences
of a document count for what their evidence -log(1 - p) exceeds the leak by: what so
many sentences of clean documents of the sample hold, and two deviations more.

The sample is turned into features and counts by tasks; the driver holds the
features that were kept and where they occur in the sample.

Defined cases: null, empty and wordless texts score 0. A sentence without any
word of the model counts 0. Without labelled rows of both classes every score is
0. Repeated ids each get a result; of a labelled id with several texts one is
learned from; other columns are ignored; whole texts are read, and a run of words
without a full stop is cut into sentences of MAX_SENTENCE words. Equal scores need
no order: sentences are listed by place.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm.common import chunks, discard, fold, lean, materialise, read_table, ship, texts

#: Labelled documents from which the classifier is fitted, at most about so many of each class.
SAMPLE_PER_CLASS = 4000
#: Deviations by which a feature's share of toxic documents must differ from chance.
MIN_Z = 5.0
#: Documents of the sample that a feature must occur in.
MIN_DOCS = 3
#: Deviations of clean evidence that the leak covers.
LEAK_DEVIATIONS = 2.0
#: Probability from which a sentence is reported.
OFFENDING = 0.5
PREFIXES = (4, 5, 6, 7)
MAX_SENTENCE = 40
TOKEN = re.compile(r"[^\W_]+|[.!?\n]")
END = frozenset(".!?\n")


def features(token: str) -> list[str]:
    """The word itself and its prefixes (marked *), which also find words of one stem."""
    word = token.lower()
    return [word, *(word[:k] + "*" for k in PREFIXES if len(word) > k)]


def bags(items: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """All words of texts, the sentence of each, and the document of each sentence."""
    words: list[str] = []
    sents, owner = [], []
    base = 0
    for d, text in enumerate(items):
        toks = TOKEN.findall(text)
        if not toks:
            continue
        stop = np.fromiter((t in END for t in toks), bool, len(toks))
        s = np.cumsum(stop)
        start = np.maximum.accumulate(np.where(np.diff(s, prepend=-1) != 0, np.arange(len(s)), 0))
        s = s * (len(s) // MAX_SENTENCE + 2) + (np.arange(len(s)) - start) // MAX_SENTENCE
        s = s[~stop]
        if not len(s):
            continue
        words += [t for t in toks if t not in END]
        s = np.cumsum(np.diff(s, prepend=s[0]) != 0)
        sents.append(s + base)
        n = int(s[-1]) + 1
        owner.append(np.full(n, d))
        base += n
    if not sents:
        return [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    return words, np.concatenate(sents), np.concatenate(owner)


def sentence_spans(text: str) -> list[tuple[int, int]]:
    """Start and end of the sentences of bags([text])."""
    own = [m.span() for m in TOKEN.finditer(text) if m[0] not in END]
    _, sent, _ = bags([text])
    heads = np.flatnonzero(np.diff(sent, prepend=-1))
    tails = np.append(heads[1:], len(sent)) - 1 if len(heads) else heads
    return [(own[i][0], own[j][1]) for i, j in zip(heads.tolist(), tails.tolist(), strict=True)]


class Weights(dict):
    """A word's weight, the sum of its features' weights; nan if it has none. Filled as words come up."""

    def __init__(self, of: dict[str, float]):
        super().__init__()
        self.of = of

    def __missing__(self, word: str) -> float:
        if len(self) > 300_000:
            self.clear()
        own = [self.of[f] for f in features(word) if f in self.of]
        self[word] = out = sum(own) if own else np.nan
        return out


class Model:
    """weights: of the features of words, with a bias at the end; leak: mean and deviation of a clean sentence's evidence."""

    def __init__(self, words: list[str], weights: np.ndarray, leak: tuple[float, float] = (0.0, 0.0)):
        self.words, self.weights, self.leak = words, weights, leak

    def cache(self) -> Weights:
        return Weights(dict(zip(self.words, self.weights.tolist(), strict=False)))

    def sentence_scores(self, items: list[str], cache: Weights) -> tuple[np.ndarray, np.ndarray]:
        """Each sentence's probability, and its document."""
        words, sent, owner = bags(items)
        w = np.fromiter(map(cache.__getitem__, words), np.float64, len(words))
        hit = ~np.isnan(w)
        n = len(owner)
        z = np.bincount(sent[hit], weights=w[hit], minlength=n) + (self.weights[-1] if len(self.weights) else 0)
        some = np.bincount(sent[hit], minlength=n) > 0
        return np.where(some, 1 / (1 + np.exp(-np.clip(z, -50, 50))), 0.0), owner


def evidence(p: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.minimum(p, 1 - 1e-12))


def noisy_or(p: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.clip(1 - np.exp(-np.bincount(owner, weights=evidence(p), minlength=n)), 0, 1)


def leaky_or(p: np.ndarray, owner: np.ndarray, n: int, leak: tuple[float, float]) -> np.ndarray:
    """Noisy-or of each document's worst sentence and of what the others hold beyond the leak. owner ascends."""
    e = evidence(p)
    worst = np.zeros(n)
    np.maximum.at(worst, owner, e)
    size = np.bincount(owner, minlength=n)
    rest = np.bincount(owner, weights=e, minlength=n) - worst - leak[0] * size - LEAK_DEVIATIONS * leak[1] * np.sqrt(size)
    return np.clip(1 - np.exp(-worst - np.maximum(rest, 0)), 0, 1)


def ascend(feat: np.ndarray, sent: np.ndarray, owner: np.ndarray, y: np.ndarray, size: int, rounds: int = 250, l2: float = 2e-4) -> np.ndarray:
    """Weights of size features and a bias by gradient ascent (Adam) on the noisy-or likelihood.

    feat and sent: each occurrence's feature and sentence; owner: each sentence's document; y: each document's label.
    """
    w = np.zeros(size + 1)
    w[-1] = -3
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        grad = gradient(w, feat, sent, owner, y) - l2 * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w += 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def gradient(w: np.ndarray, feat: np.ndarray, sent: np.ndarray, owner: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Gradient of the mean log likelihood of the documents' labels."""
    z = np.bincount(sent, weights=w[feat], minlength=len(owner)) + w[-1]
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    doc = np.clip(noisy_or(p, owner, len(y)), 1e-9, 1 - 1e-9)
    # d log likelihood / dz: for y = 1 (1 - P) / P * p, for y = 0 -p
    g = np.where(y[owner] == 1, (1 - doc[owner]) / doc[owner], -1.0) * p
    return np.concatenate([np.bincount(feat, weights=g[sent], minlength=len(w) - 1), [g.sum()]]) / max(len(y), 1)


def _document_features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for text, label in zip(texts(b), b.column("label").to_pylist(), strict=True):
            own = sorted({f for t in set(TOKEN.findall(text)) - END for f in features(t)})
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([label] * len(own), pa.int64())], ["feature", "label"])


def _occurrences(get):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, known = get(), {}
        for b in batches:
            for text, label in zip(texts(b), b.column("label").to_pylist(), strict=True):
                words, sent, owner = bags([text])
                for t in set(words):
                    if t not in known:
                        known[t] = [index[f] for f in features(t) if f in index]
                own = [(s, i) for t, s in zip(words, sent.tolist(), strict=True) for i in known[t]]
                yield pa.RecordBatch.from_arrays([pa.array([label], pa.int64()), pa.array([len(owner)], pa.int64()), *(pa.array([[x[k] for x in own]], pa.list_(pa.int32())) for k in (0, 1))], ["label", "sentences", "sent", "feat"])
                if len(known) > 300_000:
                    known.clear()

    return run


def fit(rows: DataFrame) -> Model:
    """A model from rows (label, text): features and their places are found by tasks, the weights here."""
    per_class = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if set(per_class) != {0, 1}:
        return Model([], np.zeros(0))
    n, base = sum(per_class.values()), per_class[1] / sum(per_class.values())
    counts = rows.mapInArrow(lean(_document_features), "feature string, label bigint").groupBy("feature").agg(F.count("*").alias("n"), F.sum("label").alias("toxic"))
    away = F.abs(F.col("toxic") - F.col("n") * base) / F.sqrt(F.col("n") * (base * (1 - base)))
    words = sorted(r.feature for r in counts.where((F.col("n") >= MIN_DOCS) & (away >= MIN_Z)).select("feature").collect())  # of the bounded sample
    held = rows.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(words)})
    found = rows.mapInArrow(lean(_occurrences(lambda: held.value)), "label bigint, sentences bigint, sent array<int>, feat array<int>").toArrow()
    y, total = found.column("label").to_numpy(), found.column("sentences").to_numpy()
    size = np.array([len(x) for x in found.column("feat")], dtype=np.int64)
    flat = [np.concatenate([np.zeros(0, np.int64), *(x.values.to_numpy() for x in found.column(c) if len(x))]).astype(np.int64) for c in ("sent", "feat")]
    used, sent = np.unique(np.repeat(np.cumsum(total) - total, size) + flat[0], return_inverse=True)  # sentences with features
    owner = np.searchsorted(np.cumsum(total), used, side="right")
    w = ascend(flat[1], sent, owner, y, len(words))
    p = 1 / (1 + np.exp(-np.clip(np.bincount(sent, weights=w[flat[1]], minlength=len(used)) + w[-1], -50, 50)))
    clean, sentences = evidence(p[y[owner] == 0]), max(int(total[y == 0].sum()), 1)  # sentences without features hold none
    mean = clean.sum() / sentences
    return Model(words, w, (float(mean), float(np.sqrt(max((clean**2).sum() / sentences - mean**2, 0)))))


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Fit on documents of labels (doc_id, toxic): per_class of each class at most, the first by a hash of the id."""
    ids = None
    for c in (0, 1):
        own = labels.where(F.col("toxic") == c).select("doc_id", F.col("toxic").cast("bigint").alias("label")).dropDuplicates(["doc_id"])
        own = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        ids = own if ids is None else ids.union(own)
    ids = materialise(ids, "toxic")  # at most two times per_class narrow rows
    rows = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = materialise(rows.select("label", "text"), "labelled")
    model = fit(rows)
    discard(ids, rows)
    return model


SCHEMA = "doc_id bigint, score double, n_sentences int, worst_sentence int, worst_score double, offending array<struct<start:int,end:int,score:double>>"


def score(docs: DataFrame, model: Model, offending: float = OFFENDING) -> DataFrame:
    """Score of every document, the number, index and score of its most toxic sentence (-1 if it has none), and the sentences that reach offending with their places in the text."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        cache = m.cache()
        for b in batches:
            items, ids = texts(b), b.column("doc_id").cast(pa.int64())
            for lo, hi in chunks(items):
                n = hi - lo
                p, owner = m.sentence_scores(items[lo:hi], cache)
                count = np.bincount(owner, minlength=n)
                first = np.cumsum(count) - count
                worst, top = np.full(n, -1), np.zeros(n)
                if len(p):
                    order = np.lexsort((np.arange(len(p)), -p, owner))
                    heads = order[np.diff(owner[order], prepend=-1) != 0]
                    worst[owner[heads]] = heads - first[owner[heads]]
                    top[owner[heads]] = p[heads]
                found: list[list[dict]] = [[] for _ in range(n)]
                bad = np.flatnonzero(p >= offending)
                for d in np.unique(owner[bad]).tolist():
                    places = sentence_spans(items[lo + d])
                    found[d] = [{"start": places[k][0], "end": places[k][1], "score": float(p[first[d] + k])} for k in (bad[owner[bad] == d] - first[d]).tolist()]
                yield pa.RecordBatch.from_arrays([ids.slice(lo, n), pa.array(leaky_or(p, owner, n, m.leak)), pa.array(count.astype(np.int32)), pa.array(worst.astype(np.int32)), pa.array(top), pa.array(found, spans)], ["doc_id", "score", "n_sentences", "worst_sentence", "worst_score", "offending"])

    return docs.select("doc_id", "text").mapInArrow(lean(run), SCHEMA)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    model = train(docs, labels.where(fold(F.col("doc_id"), 5) != 0))
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_sentences", "offending")
