"""Operators as stages of a pipeline: rows of documents in, rows of documents out."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm import decontaminate, jaccard_join, language, pii
from furrow.llm.common import chunks, lean, materialise, parted, ship, texts, tidy

#: Share of a document's letters that its language must hold.
MIN_SHARE = 0.5


def _replaced(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns.get(n, batch.column(n)) for n in batch.schema.names], batch.schema.names)


def keep_identified(docs: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """Documents with one main language, which becomes their lang, with all other columns.

    Null, empty and letterless texts go, and those without a language that holds min_share of their letters; ties go
    to the first in alphabetical order. Without labelled rows (or without lang) only letterless documents go. Whole
    texts are read; repeated rows stay or go together; no rows give none.
    """
    named = "lang" in docs.columns
    model = language.train(language.training_rows(docs if named else docs.withColumn("lang", F.lit(None).cast("string"))))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b in batches:
            items = texts(b)
            for lo, hi in chunks(items, language.VITERBI_CHARS):
                part = b.slice(lo, hi - lo)
                if not m.langs:
                    yield part.filter(pa.array([any(c.isalpha() for c in t) for t in items[lo:hi]], pa.bool_()))
                    continue
                out = language._label(m, pa.nulls(hi - lo, pa.int64()), items[lo:hi], language.SWITCH_PENALTY, False)
                keep = np.array(out.column("lang_pred").to_pylist()) != "und"
                keep &= out.column("score").to_numpy() >= min_share
                yield (_replaced(part, lang=out.column("lang_pred")) if named else part).filter(pa.array(keep))

    return docs.mapInArrow(lean(run), docs.schema)


def keep_first_of_group(docs: DataFrame) -> DataFrame:
    """Of each component of near duplicates the document with the smallest id, with all its columns; of rows with the same id and text one.

    Null and empty texts and null ids are linked with nothing and stay (repeated empty rows of one id count as one);
    whole texts are read; equal documents tie, and the smallest id wins. No rows give none.
    """
    with tidy() as kept:
        found = materialise(jaccard_join.join(docs), "groups")
        kept.append(found)
    _, first = parted(docs, found.where("component_id <> doc_id").select("doc_id").distinct())
    repeated = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return first
    several, once = parted(first, repeated)
    return once.union(several.dropDuplicates(["doc_id", "text"]))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without any passage of benchmark, with all their columns.

    Null and empty texts hold none and stay; whole texts are read; repeated rows stay or go together.
    Without passages every row stays; no rows give none.
    """
    out = docs
    for held, only in decontaminate.passage_blocks(benchmark):

        def run(batches: Iterable[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = decontaminate.Index(held.value)
            for b in batches:
                items = [decontaminate.normal(t) for t in texts(b)]
                keep = np.ones(len(items), dtype=bool)
                for lo, hi in chunks(items, 500_000):
                    keep[[lo + hit[0] for hit in index.search(items[lo:hi], all_places=False)]] = False
                yield b.filter(pa.array(keep))

        out = out.mapInArrow(lean(run), docs.schema)
        if not only:
            out = materialise(out, "clean")
    return out


def mask_personal_data(docs: DataFrame) -> DataFrame:
    """Documents with spans of personal data replaced by their kind; n_chars, where there is one, follows.

    Null texts stay null and empty ones empty, with the n_chars that they had; whole texts are read; every row
    stays, repeated ones too, and other columns are kept; spans that tie or touch are settled by the operator. No
    rows give none.
    """
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(pii.trained())
    sized = "n_chars" in docs.columns
    if sized:
        docs = docs.withColumn("n_chars", F.col("n_chars").cast("bigint"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = held.value
        memory = crf.memory()
        for b in batches:
            for lo, hi in chunks(texts(b)):
                part = b.slice(lo, hi - lo)
                raw = part.column("text").to_pylist()
                found = pii.find([t or "" for t in raw], crf, memory)
                new = [pii.mask(t, every) if every else t for t, (_, every) in zip(raw, found, strict=True)]
                more = {"n_chars": pa.array([len(t) if every else n for t, (_, every), n in zip(new, found, part.column("n_chars").to_pylist(), strict=True)], pa.int64())} if sized else {}
                yield _replaced(part, text=pa.array(new, pa.string()), **more)

    return docs.mapInArrow(lean(run), docs.schema)
