"""Helpers that the training-data operators share: shared storage, text batches, bitmaps, components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.session import fresh_path, ship

#: Rows up to which a side is broadcast; beyond it the join is left to shuffle.
BROADCAST_ROWS = 200_000
#: Code points handled at once by the numpy parts of an operator.
CHUNK_CHARS = 1_000_000
#: Bits of a membership bitmap (8 MB); a fuller bitmap lets more rows through, never fewer.
BITMAP_BITS = 1 << 26
#: Spark's setting by which the shuffle files of a query go when it ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_tables: list[DataFrame] = []


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that run inside the block are deleted as each ends; a query that is run again makes them anew."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: lineage and shuffle files end there.

    Tables stand in a folder of the application, so whatever a lazy result still reads at its end can be removed with that.
    """
    spark = df.sparkSession
    ship(spark)
    path = fresh_path(spark, name)
    with freed(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._furrow_path = path
    _tables.append(out)
    return out


@contextmanager
def tidy() -> Iterator[list[DataFrame]]:
    """Delete the tables that materialise() makes inside the block, but for those put into the list that it gives."""
    at, kept = len(_tables), []
    try:
        yield kept
    finally:
        discard(*(t for t in _tables[at:] if not any(t is k for k in kept)))


def discard(*tables: DataFrame) -> None:
    """Delete tables of materialise() that nothing reads any more."""
    for df in tables:
        _tables[:] = [t for t in _tables if t is not df]
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._furrow_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def maybe_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark df for broadcast when a count shows at most limit (narrow) rows; else leave it to shuffle."""
    with freed(df.sparkSession):
        return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def give_back() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run for mapInArrow, giving freed memory back when a task ends: workers live on and serve other stages."""

    def wrapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(doc_id.cast("string")) % n


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The strings of a column, null as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def byte_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a column, null as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def chunks(items: list[str], size: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of items of about size characters each; a longer item stands alone."""
    start, total = 0, 0
    for i, x in enumerate(items):
        if total and total + len(x) > size:
            yield start, i
            start, total = i, 0
        total += len(x) + 1
    if start < len(items):
        yield start, len(items)


def codepoints(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def expand(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts [2, 1]: owners [0, 0, 1] and offsets within the owner [0, 1, 0]."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def _bit_positions(values: np.ndarray) -> np.ndarray:
    return mix64(values.view(np.uint64) if values.dtype == np.int64 else values.astype(np.uint64)) & np.uint64(BITMAP_BITS - 1)


def bitmap(df: DataFrame, column: str) -> np.ndarray:
    """A bitmap of fixed size over hashed bigint values of df.column.

    Whoever tests membership sees every value of df and perhaps a few more; the
    size doesn't grow with df, so it can be sent to every task.
    """

    def positions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = np.unique(_bit_positions(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array((p >> np.uint64(16)).astype(np.int32)), pa.array((p & np.uint64(0xFFFF)).astype(np.int32))], ["block", "off"])

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            blocks, packed = [], []
            for block, offs in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                bits = np.zeros(1 << 16, dtype=bool)
                bits[offs.values.to_numpy(zero_copy_only=False)] = True
                blocks.append(block)
                packed.append(np.packbits(bits, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(packed, pa.binary())], ["block", "bits"])

    found = df.select(F.col(column).cast("bigint")).dropna().mapInArrow(positions, "block int, off int").groupBy("block").agg(F.collect_set("off").alias("offs"))
    out = np.zeros(BITMAP_BITS // 8, dtype=np.uint8)
    with freed(df.sparkSession):
        rows = found.mapInArrow(pack, "block int, bits binary").collect()
    for row in rows:
        out[row.block * 8192 : (row.block + 1) * 8192] = np.frombuffer(row.bits, dtype=np.uint8)
    return out


def in_bitmap(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    return at_bits(bits, _bit_positions(values))


def at_bits(bits: np.ndarray, positions: np.ndarray) -> np.ndarray:
    return (bits[(positions >> np.uint64(3)).astype(np.int64)] >> (positions & np.uint64(7)).astype(np.uint8)) & 1 > 0


def depth_in_bitmaps(nested: list[np.ndarray], values: np.ndarray) -> np.ndarray:
    """For each value how many of nested, one after the other, hold it until one doesn't."""
    positions, depth = _bit_positions(values), np.zeros(len(values), dtype=np.int64)
    at = np.arange(len(values))
    for bits in nested:
        at = at[at_bits(bits, positions[at])]
        depth[at] += 1
    return depth


def _at_depth(get, depth: int):
    """Rows whose doc_id is in so many of the nested bitmaps of get(); a null one is in none."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nested = get()
        for b in batches:
            ids = b.column("doc_id").cast(pa.int64())
            found = depth_in_bitmaps(nested, ids.fill_null(0).to_numpy(zero_copy_only=False))
            found[ids.is_null().to_numpy(zero_copy_only=False)] = 0
            yield b.filter(pa.array(found == depth))

    return run


def parted(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of docs whose doc_id is in ids (doc_id bigint, none null), and all others, with null ones (exact).

    Whole rows are told apart by bitmaps of fixed size, however many ids there are. Only those of documents that pass
    for one of ids, and of ids that these pass for, are joined.
    """
    hold = docs.sparkSession.sparkContext.broadcast
    ship(docs.sparkSession)
    outer = bitmap(ids, "doc_id")
    held = hold([outer])
    passing = docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).mapInArrow(lean(_at_depth(lambda: held.value, 1)), "doc_id bigint")
    wrong = materialise(passing.join(ids.hint("merge"), "doc_id", "left_anti").distinct(), "wrong")
    held.destroy()
    nested = hold([outer, bitmap(wrong, "doc_id")])
    others, inside, doubtful = (docs.mapInArrow(lean(_at_depth(lambda: nested.value, k)), docs.schema) for k in range(3))
    wrong = maybe_broadcast(wrong)
    return tuple(sure.union(doubtful.join(wrong, "doc_id", how).select(docs.columns)) for sure, how in ((inside, "left_anti"), (others, "left_semi")))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of edges (a bigint, b bigint): rows (id, component_id), the smallest id.

    Alternates the large-star and small-star steps, each a shuffle of the edges,
    and stops when a round changes nothing; the number of rounds grows with the
    logarithm of the number of nodes. Every round ends in a table of its own, so
    that a lost executor costs at most one round.
    """
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    stars = materialise(both, "cc")
    state = None
    for _ in range(rounds):
        # large star: every larger neighbour goes to the smallest of the neighbourhood
        sym = stars.union(stars.select(F.col("v"), F.col("u"))).toDF("n", "m")
        low = sym.groupBy("n").agg(F.min("m").alias("lo")).select("n", F.least("n", "lo").alias("lo"))
        large = sym.where("m > n").join(low, "n").where("m <> lo").select(F.col("m").alias("u"), F.col("lo").alias("v")).distinct()
        # small star: the smaller neighbours and the node itself go to the smallest
        low2 = large.groupBy("u").agg(F.min("v").alias("lo"))
        small = large.join(low2, "u").where("v <> lo").select(F.col("v").alias("u"), F.col("lo").alias("v")).union(low2.select("u", F.col("lo").alias("v"))).distinct()
        before, stars = stars, materialise(small, "cc")
        discard(before)
        now = tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    roots = stars.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(roots)
