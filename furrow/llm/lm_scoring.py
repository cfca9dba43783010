"""Cross-entropy difference under matched bigram models (operator 1).

A target model (documents labelled good) and a background model (all documents)
share one vocabulary, order and smoothing. Each word of a document costs its
negative log probability under either; the mean of the differences is the score,
lower for text closer to the target.

    p(w)     = (c(w) + 1/2) / (N + V/2)
    p(w | v) = (c(v, w) + MU * p(w)) / (c(v) + MU)

The vocabulary is every word of every document (V counts <unk> and <s> too), so the
models grow with the corpus and no task holds one of them. Documents are read in
chunks; a chunk sends its distinct words and bigrams with their counts, as hashes of
56 bits (of 10^9 bigrams about one in 10^8 meets another), to buckets of the hash range, a bucket adds the counts of all chunks up and
answers each chunk in the order of its question, and the chunk scores its documents
with the answers. A common word or bigram is one entry of each chunk; a chunk sends
nothing to buckets that it has no entry for, so what is sent is at most the entries.

Documents of the target are scored by a model that has counted them, as all documents
are by that of the background.

Defined cases: null text counts as empty; a text without words has n_tokens 0 and
scores 0. Without target documents the target model is uniform. A document that
is labelled more than once counts once; a null id is in no target. Repeated rows
each count and each get a score; other columns are ignored; whole texts are read.
Nothing is ranked, so there are no ties. An empty table gives no rows. Words are
split at ASCII white space and A-Z is lower-cased.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from hashlib import blake2b
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm.common import byte_texts, give_back, lean, materialise, maybe_broadcast, mix64, read_table

MU = 100.0
#: Entries of a bucket, about; their number follows the corpus.
BUCKET_ENTRIES = 1_000_000
CHUNK_BYTES = 8_000_000
_LESS = np.uint64(8)  # bits that are left out of hashes: what is sent has a byte less for each entry


def _marked(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    marks = maybe_broadcast(target_ids.select("doc_id", F.lit(True).alias("target")).dropDuplicates(["doc_id"]))
    return docs.select("doc_id", "text").join(marks, "doc_id", "left").select("doc_id", "text", F.coalesce("target", F.lit(False)).alias("target"))


SCHEMA = "doc_id bigint, n_tokens bigint, ce_target double, ce_background double, score double"


def _pack(a: np.ndarray) -> bytes:
    """Whole numbers from 0 up as compressed planes of bytes, without the high planes that are all zero."""
    a = np.ascontiguousarray(a, dtype=np.uint64)
    k = max(1, (int(a.max(initial=0)).bit_length() + 7) // 8)
    return bytes([k]) + len(a).to_bytes(8) + pa.compress(a.view(np.uint8).reshape(-1, 8)[:, :k].T.tobytes(), "zstd", asbytes=True)


def _unpack(data: bytes) -> np.ndarray:
    k, n = data[0], int.from_bytes(data[1:9])
    out = np.zeros((n, 8), dtype=np.uint8)
    if n:
        out[:, :k] = np.frombuffer(pa.decompress(data[9:], k * n, "zstd"), np.uint8).reshape(k, n).T
    return out.view(np.uint64).ravel()


def _pack_sorted(keys: np.ndarray) -> bytes:
    return keys[:1].tobytes() + _pack(np.diff(keys)) if len(keys) else b""


def _unpack_sorted(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, dtype=np.uint64)
    return np.cumsum(np.concatenate([np.frombuffer(data[:8], np.uint64), _unpack(data[8:])]), dtype=np.uint64)


CHUNKS = "chunk bigint, doc_ids array<bigint>, sizes array<bigint>, targets array<boolean>, ids binary, hashes binary, entries bigint, tokens bigint, own_tokens bigint, starts bigint, own_starts bigint"


def _read_chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents in chunks of CHUNK_BYTES: their words as ids of the chunk's own words, and the hashes of those."""
    chunk = TaskContext.get().partitionId() << 32
    docs: list[int | None] = []
    targets: list[bool] = []
    sizes: list[int] = []
    ids: list[np.ndarray] = []
    known: defaultdict[bytes, int] = defaultdict(count().__next__)
    read = 0

    def close() -> pa.RecordBatch:
        size, own = np.array(sizes), np.array(targets, dtype=bool)
        hashes = b"".join(blake2b(w, digest_size=8).digest() for w in known)
        sums = (len(known) + sum(sizes), sum(sizes), int(size[own].sum()), int((size > 0).sum()), int((size[own] > 0).sum()))
        row = [[chunk], [docs], [sizes], [targets], [_pack(np.concatenate(ids))], [hashes], *([x] for x in sums)]
        types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.binary(), *[pa.int64()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, types, strict=True)], ["chunk", "doc_ids", "sizes", "targets", "ids", "hashes", "entries", "tokens", "own_tokens", "starts", "own_starts"])

    for b in batches:
        for text, doc, target in zip(byte_texts(b), b.column("doc_id").cast(pa.int64()).to_pylist(), b.column("target").to_pylist(), strict=True):
            w = text.lower().split()
            ids.append(np.fromiter(map(known.__getitem__, w), np.int64, len(w)))
            docs.append(doc)
            targets.append(target)
            sizes.append(len(w))
            read += len(text)
            if read >= CHUNK_BYTES:
                yield close()
                chunk, read = chunk + 1, 0
                docs, targets, sizes, ids, known = [], [], [], [], defaultdict(count().__next__)
    if docs:
        yield close()


class Chunk:
    """Words and distinct bigrams of a row of CHUNKS, and the order in which they go to buckets; n stands for <s>."""

    def __init__(self, row: dict):
        self.sizes, self.ids = np.array(row["sizes"], dtype=np.int64), _unpack(row["ids"]).astype(np.int64)
        words = np.frombuffer(row["hashes"], np.uint64) >> _LESS
        self.n = n = len(words)
        self.prev = np.concatenate([[n], self.ids[:-1]]) if len(self.ids) else self.ids
        self.prev[(np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]] = n
        code, self.gram = np.unique(self.prev * (n + 1) + self.ids, return_inverse=True)
        self.v, self.w = code // (n + 1), code % (n + 1)
        grams = mix64(mix64(np.append(words ^ np.uint64(0x9E3779B97F4A7C15), np.uint64(1)))[self.v] + words[self.w]) >> _LESS if n else words
        self.word_order, self.gram_order = np.argsort(words), np.argsort(grams)
        self.words, self.grams = words[self.word_order], grams[self.gram_order]


def _ask(buckets: int):
    """For each chunk and bucket the sorted hashes of its words and bigrams with counts of both models: of words as such and as contexts."""

    def cuts(keys: np.ndarray) -> np.ndarray:
        at = (keys >> np.uint64(24)) * np.uint64(buckets) >> np.uint64(32)
        return np.searchsorted(at.astype(np.int64), np.arange(buckets + 1))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                row = b.slice(k, 1).to_pylist()[0]
                c = Chunk(row)
                own = np.repeat(np.array(row["targets"], dtype=bool), c.sizes)
                word = np.stack([np.bincount(x, minlength=c.n + 1)[: c.n][c.word_order] for x in (c.ids, c.ids[own], c.prev, c.prev[own])])
                gram = np.stack([np.bincount(x, minlength=len(c.v))[c.gram_order] for x in (c.gram, c.gram[own])])
                cw, cg = cuts(c.words), cuts(c.grams)
                own = np.flatnonzero((np.diff(cw) > 0) | (np.diff(cg) > 0))
                if len(own):
                    out = [(_pack_sorted(c.words[i:j]), _pack(word[:, i:j].ravel()), _pack_sorted(c.grams[x:y]), _pack(gram[:, x:y].ravel())) for i, j, x, y in zip(cw[own], cw[own + 1], cg[own], cg[own + 1], strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array([row["chunk"]] * len(own), pa.int64()), *(pa.array(x, pa.binary()) for x in zip(*out, strict=True))], ["bucket", "chunk", "words", "word_counts", "grams", "gram_counts"])

    return run


def _distinct_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for x in b.column("hashes").to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x, np.int64))], ["word"])


def _answer(table: pa.Table) -> pa.Table:
    """Counts over all chunks for what each chunk asked of one bucket."""

    def totals(keys: str, counts: str, models: int) -> list[bytes]:
        asked = [_unpack_sorted(x.as_py()) for x in table.column(keys)]
        given = np.concatenate([_unpack(x.as_py()).reshape(models, -1) for x in table.column(counts)], axis=1)
        found, at = np.unique(np.concatenate(asked), return_inverse=True)
        both = np.stack([np.bincount(at, weights=x, minlength=len(found)) for x in given]).astype(np.int64)
        ends = np.cumsum([len(x) for x in asked])
        return [_pack(both[:, at[e - len(x) : e]].ravel()) for x, e in zip(asked, ends, strict=True)]

    word, gram = totals("words", "word_counts", 4), totals("grams", "gram_counts", 2)
    give_back()
    return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "word_counts": pa.array(word, pa.binary()), "gram_counts": pa.array(gram, pa.binary())})


def score(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """Mean losses per word of every document of docs (doc_id, text) under both models, and their difference; target_ids (doc_id) are those of the target's documents."""
    chunks = materialise(_marked(docs, target_ids).mapInArrow(lean(_read_chunks), CHUNKS), "chunks")
    entries, *sums = (x or 0 for x in chunks.agg(*(F.sum(c) for c in ("entries", "tokens", "own_tokens", "starts", "own_starts"))).first())
    asked = chunks.select("chunk", "sizes", "targets", "ids", "hashes").mapInArrow(lean(_ask(entries // BUCKET_ENTRIES + 1)), "bucket int, chunk bigint, words binary, word_counts binary, grams binary, gram_counts binary")
    size = chunks.select("hashes").mapInArrow(lean(_distinct_words), "word bigint").distinct().count() + 2
    answers = asked.groupBy("bucket").applyInArrow(_answer, "chunk bigint, bucket int, word_counts binary, gram_counts binary")

    def run(chunk: pa.Table, answer: pa.Table) -> pa.Table:
        row, answer = chunk.to_pylist()[0], answer.sort_by("bucket")
        c = Chunk(row)
        word, gram = np.zeros((4, c.n)), np.zeros((2, len(c.v)))
        word[:, c.word_order] = np.concatenate([np.zeros((4, 0)), *(_unpack(x.as_py()).reshape(4, -1) for x in answer.column("word_counts"))], axis=1)
        gram[:, c.gram_order] = np.concatenate([np.zeros((2, 0)), *(_unpack(x.as_py()).reshape(2, -1) for x in answer.column("gram_counts"))], axis=1)
        owner, means = np.repeat(np.arange(len(c.sizes)), c.sizes), []
        for k in (1, 0):
            p = (word[k] + 0.5) / (sums[k] + 0.5 * size)
            context = np.append(word[2 + k], sums[2 + k])
            loss = -np.log((gram[k] + MU * p[c.w]) / (context[c.v] + MU))
            means.append(np.bincount(owner, weights=loss[c.gram], minlength=len(c.sizes)) / np.maximum(c.sizes, 1))
        give_back()
        return pa.table({"doc_id": pa.array(row["doc_ids"], pa.int64()), "n_tokens": c.sizes, "ce_target": means[0], "ce_background": means[1], "score": means[0] - means[1]})

    return chunks.select("chunk", "doc_ids", "sizes", "ids", "hashes").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, SCHEMA)


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    out = score(docs, labels.where("quality = 1").select("doc_id"))
    return out.select("doc_id", "n_tokens", *(F.round(c, 6).alias(c) for c in ("ce_target", "ce_background", "score")))


def op1_sql() -> str:
    """The same in SQL: both models over every word."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def model(name: str, source: str) -> str:
        return f"""
    {name}_n AS (SELECT count(*) AS n FROM {source}),
    {name}_u AS (SELECT w, count(*) AS c FROM {source} GROUP BY w),
    {name}_p AS (SELECT ids.w, (coalesce(c, 0) + 0.5::DOUBLE) / (n + 0.5::DOUBLE * v) AS p FROM ids CROSS JOIN {name}_n CROSS JOIN size LEFT JOIN {name}_u USING (w)),
    {name}_v AS (SELECT v, count(*) AS cv FROM {source} GROUP BY v),
    {name}_b AS (SELECT v, w, count(*) AS cvw FROM {source} GROUP BY v, w)"""

    def loss(name: str) -> str:
        return f"-ln((coalesce({name}_b.cvw, 0) + {MU}::DOUBLE * {name}_p.p) / (coalesce({name}_v.cv, 0) + {MU}::DOUBLE))"

    joins = " ".join(f"LEFT JOIN {m}_b ON {m}_b.v = g.v AND {m}_b.w = g.w JOIN {m}_p ON {m}_p.w = g.w LEFT JOIN {m}_v ON {m}_v.v = g.v" for m in ("t", "b"))
    return f"""
    WITH raw AS (
        SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
        FROM documents),
    tok AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM raw),
    grams AS (SELECT doc_id, word AS w, coalesce(lag(word) OVER (PARTITION BY doc_id ORDER BY pos), '<s> ') AS v FROM tok),
    good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
    tgrams AS (SELECT grams.* FROM grams SEMI JOIN good USING (doc_id)),
    ids AS (SELECT DISTINCT word AS w FROM tok),
    size AS (SELECT count(*) + 2 AS v FROM ids),{model("t", "tgrams")},{model("b", "grams")},
    each AS (SELECT g.doc_id, {loss("t")} AS lt, {loss("b")} AS lb FROM grams g {joins}),
    sums AS (SELECT doc_id, count(*) AS n, avg(lt) AS t, avg(lb) AS b FROM each GROUP BY doc_id)
    SELECT raw.doc_id, coalesce(n, 0)::BIGINT AS n_tokens, round(coalesce(t, 0), 6) AS ce_target, round(coalesce(b, 0), 6) AS ce_background, round(coalesce(t - b, 0), 6) AS score
    FROM raw LEFT JOIN sums USING (doc_id)"""
