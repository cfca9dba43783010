"""Exact Jaccard join of documents on word shingles (operator 9).

Two documents link when the Jaccard distance of their shingle sets is at most
1/4. The distance is a metric, so pivots and the triangle inequality split the
join into regions:

1. Pivots of the first level are single shingles, in one global order. A set A
   belongs to the region of its first shingle; since a partner lacks at most a
   quarter of A, its window reaches the first n // 4 + 1 shingles of A, and A is
   replicated to those regions. (Pivots that are whole documents can't do this
   job: unrelated documents are all at distance 1 from them, and every window
   would hold every document.) The order has levels by how many documents hold a
   shingle, rare ones first, so common passages are pivots only for documents that
   have little else.
2. Small regions give candidate pairs, kept if the number of pivots they share
   can still reach the threshold. Crowded regions are not cut or sampled: all
   their documents go on together.
3. Connected candidates form the regions of the second level. Each document's
   full set is sent there once. Inside, documents are the pivots: each cell is the
   ball of radius 1/4 around its pivot, whose members are thereby linked, and the
   triangle inequality says which documents of other cells can be near a member:
   those within twice the radius of the pivot. They are replicated to the cell and
   compared with its members, unless cell and document are connected already. Which
   pivots a document meets is again told by its rarest shingles in the region.
   A region of one block is settled there. A larger one is dealt out in blocks: each
   gives its components and pivots, and the pivots, dealt by component, form a region
   of their own, and so on while they get fewer. Near copies are one component then.
   What is left are documents outside the region's largest component: all its blocks
   are joined with them once more, again in blocks.
4. Components that these last links connect are merged.

Defined cases: null text counts as empty; sets without words link with nothing;
texts of fewer than five words are one shingle, the whole sequence. Exact copies
are one node until the end. Rows with a null id are returned with a null
component and link with nothing. Repeated rows are returned as often as given.
Columns other than doc_id and text are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm.common import bitmap, byte_texts, components, depth_in_bitmaps, discard, expand, in_bitmap, lean, materialise, maybe_broadcast, mix64, read_table, ship

WORDS = 5
#: Documents up to which a first-level region gives its pairs at once, and where further levels of the order begin.
CROWD, LEVELS = 16, (16, 512, 16384)
#: Crowded shingles are looked for in a window longer by this part of the set.
WIDER = 16
#: Documents and shingles of a block of a large second-level region, and the share of documents that a round must leave out for another one.
BLOCK_DOCS, BLOCK_SHINGLES, SHRINK = 256, 2_000_000, 0.25
#: Blocks into which the last comparison of a large region deals its documents, unless blocks of BLOCK_DOCS are fewer or one would have more documents than LAST_DOCS.
LAST_BLOCKS, LAST_DOCS = 8, 2048
#: Documents of one side whose counts are held at once, columns of a matrix product, pairs listed at once, and the share of all pairs from which a shingle is a column.
TILE, COLUMNS, LISTED, DENSE = 256, 512, 2_000_000, 1 / 64
#: Parts into which the documents of a crowded shingle are dealt before they are tied.
SALTS = 64
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_BITS = 60  # of a shingle's hash; the level stands above


class WordHash(dict):
    """64-bit hashes of words, filled as they come up."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: bytes, cache: WordHash) -> np.ndarray:
    """Sorted 60-bit hashes of the distinct shingles of a text. bytes.lower and bytes.split know ASCII only, as wanted."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    k = min(WORDS, len(words))
    n = len(words) - k + 1
    acc = np.full(n, k, np.uint64)
    for j in range(k):
        acc += h[j : j + n] * _ODD[j]
    return np.unique((mix64(acc) >> np.uint64(64 - _BITS)).view(np.int64))


def _described(get=None):
    """Set size, fingerprint and first pivots of every document.

    Without get(), pivots in hash order, somewhat more than the window, so that
    crowded shingles are also found where the window will move on to. With get(),
    which gives the shingles of each level, the window in the final order.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, crowded = WordHash(), get and get()
        for b in batches:
            sizes, f1, f2, wins = [], [], [], []
            for t in byte_texts(b):
                s = shingle_set(t, cache)
                d = xxhash.xxh3_128_intdigest(s.tobytes())
                k = len(s) // 4 + 1
                sizes.append(len(s))
                f1.append((d >> 64) - (1 << 63))
                f2.append((d & (1 << 64) - 1) - (1 << 63))
                wins.append(s[: k + len(s) // WIDER + 2] if crowded is None else np.sort(_later(s, crowded))[:k])
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int32()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), _lists(wins)], ["doc_id", "n", "f1", "f2", "win"])

    return run


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64)))


def _later(s: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Shingles as keys of the global order: the more documents hold one, the later."""
    return s + (depth_in_bitmaps(levels, s) << _BITS)


def _shared(get):
    """Window entries (t, doc_id, n, crowd) of shingles that other windows hold too, by the bitmaps of get(); both may let a few more through."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        several, crowds = get()
        for b in batches:
            win = b.column("win")
            t = win.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(b.num_rows), np.diff(win.offsets.to_numpy()))
            at = np.flatnonzero(in_bitmap(several, t))
            own = pa.array(row[at])
            yield pa.RecordBatch.from_arrays([pa.array(t[at]), b.column("doc_id").take(own), b.column("n").take(own), pa.array(in_bitmap(crowds, t[at]))], ["t", "doc_id", "n", "crowd"])

    return run


def _full_sets(get):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, cache = get(), WordHash()
        for b in batches:
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            near = np.flatnonzero(in_bitmap(wanted, ids)) if len(ids) else []
            sets = [shingle_set(t, cache) for t in byte_texts(b.take(pa.array(near, pa.int64())))]
            digests = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(ids[near].astype(np.int64)), pa.array([(d >> 64) - (1 << 63) for d in digests], pa.int64()), pa.array([(d & (1 << 64) - 1) - (1 << 63) for d in digests], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "f1", "f2", "shingles"])

    return run


class Forest:
    """Disjoint sets of positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _near(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have at least percent of their union in common."""
    least = (percent * (len(a) + len(b)) + 99 + percent) // (100 + percent)  # of the intersection
    return min(len(a), len(b)) >= least and len(np.intersect1d(a, b, assume_unique=True)) >= least


def cell_links(sets: list[np.ndarray], count: Counter | None = None, labels: list[int] | None = None) -> tuple[list[tuple[int, int]], list[int], Forest]:
    """Links between positions of sets, so many that their components are complete (exact); the pivots; and the components.

    Positions with one label are known to be connected. count, if given, counts cells, replicated documents, comparisons,
    and links inside and between cells.
    """
    n, found = len(sets), []
    count = Counter() if count is None else count
    forest, seen = Forest(n), {}
    for i, x in enumerate(labels or ()):
        forest.join(seen.setdefault(x, i), i)
    if n < 3:
        count["compared"] += n - 1
        if n == 2 and _near(*sets, 75):
            forest.join(0, 1)
            count["inside"] += 1
            return [(0, 1)], [0], forest
        return [], list(range(n)), forest
    # the rarest shingles of each set, of which near sets share one
    flat = np.concatenate(sets)
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), size)
    _, code, times = np.unique(flat, return_inverse=True, return_counts=True)
    order = np.lexsort((code, times[code], owner))
    first = np.cumsum(size) - size
    rare = [x[x >= 0].tolist() for x in (np.where(times[code[order[f : f + s // 4 + 1]]] > 1, code[order[f : f + s // 4 + 1]], -1) for f, s in zip(first, size, strict=True))]

    members: dict[int, list[int]] = {}  # of the cell of each pivot
    pivots_at: dict[int, list[int]] = {}  # pivots that have a shingle among their rarest
    cell = [0] * n
    far: set[tuple[int, int]] = set()  # pairs that don't link

    def linked(x: int, y: int) -> bool:
        if (x, y) in far or (y, x) in far:
            return False
        count["compared"] += 1
        if _near(sets[x], sets[y], 75):
            found.append((x, y))
            forest.join(x, y)
            return True
        far.add((x, y))
        return False

    for x in np.argsort(-size, kind="stable").tolist():
        met = Counter(p for t in rare[x] for p in pivots_at.get(t, ()))
        for p, _ in met.most_common():
            if linked(x, p):
                count["inside"] += 1
                members[p].append(x)
                cell[x] = p
                break
        else:
            members[x] = [x]
            cell[x] = x
            for t in rare[x]:
                pivots_at.setdefault(t, []).append(x)
    count["cells"] += len(members)
    if len(members) == 1:
        return found, list(members), forest
    cells_at: dict[int, set[int]] = {}  # cells with a member that has a shingle among its rarest
    for x in range(n):
        for t in rare[x]:
            cells_at.setdefault(t, set()).add(cell[x])
    for x in range(n):
        for p in sorted(set().union(*(cells_at[t] for t in rare[x])) - {cell[x]}) if rare[x] else ():
            if forest.find(p) == forest.find(x):
                continue
            others = members[p]
            if len(others) > 1:
                count["compared"] += 1
                if not _near(sets[x], sets[p], 50):  # further than 2 r from the pivot: further than r from all members
                    continue
            count["replicated"] += 1
            if any(linked(x, y) for y in others):
                count["between"] += 1
    return found, list(members), forest


def _join_regions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches hold regions or their blocks one after the other, documents in order, each with the label of its component so far.

    Gives (region, label, lowest, null) for labels that lie in a component with a lower one, and (region, null, null, document) for pivots.
    """
    key, ids, labels, sets = None, [], [], []
    out: list[tuple[int, int | None, int | None, int | None]] = []

    def close() -> None:
        if len(ids) == 1:
            out.append((key[0], None, None, ids[0]))
        elif ids:
            _, pivots, forest = cell_links(sets, labels=labels)
            low: dict[int, int] = {}
            for i, x in enumerate(labels):
                root = forest.find(i)
                low[root] = min(low.get(root, x), x)
            out.extend({(key[0], x, low[forest.find(i)], None) for i, x in enumerate(labels) if x != low[forest.find(i)]})
            out.extend((key[0], None, None, ids[i]) for i in pivots)

    def table() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(4)], ["region", "label", "lowest", "pivot"])

    for b in batches:
        for region, i, j, doc, label, s in zip(*(b.column(c).to_pylist() for c in ("region", "i", "j", "doc_id", "label", "shingles")), strict=True):
            if (region, i, j) != key:
                close()
                key, ids, labels, sets = (region, i, j), [], [], []
            if not ids or ids[-1] != doc:  # a document may come to a task from both sides
                ids.append(doc)
                labels.append(label)
                sets.append(np.frombuffer(s, dtype=np.int64))
        yield table()
        out.clear()
    close()
    yield table()


def rectangle_links(own: list[np.ndarray], guests: list[np.ndarray], own_labels: np.ndarray, guest_labels: np.ndarray) -> set[tuple[int, int]]:
    """Pairs of different labels with a link between a set of own and one of guests (exact): common shingles are counted for all pairs at once."""
    n, m = len(own), len(guests)
    sizes, guest_sizes = (np.array([len(s) for s in x], np.int64) for x in (own, guests))
    flat, guest_flat = np.concatenate(own), np.concatenate(guests)
    both = np.intersect1d(flat, guest_flat)

    def entries(flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the shingles that both sides have, and whose they are."""
        if not len(both):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        code = np.minimum(np.searchsorted(both, flat), len(both) - 1)
        at = np.flatnonzero(both[code] == flat)
        return code[at], np.repeat(np.arange(len(sizes)), sizes)[at]

    code, owner = entries(flat, sizes)
    guest_code, guest_owner = entries(guest_flat, guest_sizes)
    held, guest_held = (np.bincount(c, minlength=len(both)) for c in (code, guest_code))
    dense = held * guest_held > DENSE * n * m
    column = np.cumsum(dense) - 1
    order = np.argsort(code, kind="stable")
    by_code, first = owner[order], np.cumsum(held) - held
    wide = dense[code]
    wide_column, wide_owner = column[code[wide]], owner[wide]
    found: set[tuple[int, int]] = set()
    for lo in range(0, m, TILE):
        rows = min(TILE, m - lo)
        at = slice(*np.searchsorted(guest_owner, (lo, lo + rows)))
        c, row = guest_code[at], guest_owner[at] - lo
        common = np.zeros((rows, n), np.int64)
        for k in range(0, int(dense.sum()), COLUMNS):
            a, b = np.zeros((rows, COLUMNS), np.float32), np.zeros((n, COLUMNS), np.float32)
            x, y = dense[c] & (column[c] >= k) & (column[c] < k + COLUMNS), (wide_column >= k) & (wide_column < k + COLUMNS)
            a[row[x], column[c[x]] - k] = 1
            b[wide_owner[y], wide_column[y] - k] = 1
            common += (a @ b.T).astype(np.int64)
        c, row = c[~dense[c]], row[~dense[c]]
        ends = np.cumsum(held[c])
        start = 0
        while start < len(c):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + LISTED, side="right")))
            which, off = expand(held[c[start:stop]])
            other = by_code[first[c[start:stop]][which] + off]
            common += np.bincount(row[start:stop][which] * n + other, minlength=rows * n).reshape(rows, n)
            start = stop
        x, y = np.nonzero(175 * common >= 75 * (guest_sizes[lo : lo + rows, None] + sizes[None, :]))
        pairs = np.stack([guest_labels[lo + x], own_labels[y]])
        found.update(map(tuple, np.unique(pairs[:, pairs[0] != pairs[1]], axis=1).T.tolist()))
    return found


def _compare_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches hold pairs of blocks one after the other, own documents before guests. Gives (region, label, lowest) as _join_regions does."""
    key, sides = None, {False: ([], []), True: ([], [])}
    out: list[tuple[int, int, int]] = []

    def close() -> None:
        (own, own_labels), (guests, guest_labels) = sides[False], sides[True]
        if own and guests:
            links = rectangle_links(own, guests, np.array(own_labels), np.array(guest_labels))
            names = sorted({x for link in links for x in link})
            place = {x: i for i, x in enumerate(names)}
            forest = Forest(len(names))
            for a, b in links:
                forest.join(place[a], place[b])
            out.extend((key[0], x, names[forest.find(i)]) for i, x in enumerate(names) if forest.find(i) != i)
        for x in (*sides[False], *sides[True]):
            x.clear()

    def table() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(3)], ["region", "label", "lowest"])

    for b in batches:
        for region, i, j, guest, label, s in zip(*(b.column(c).to_pylist() for c in ("region", "i", "j", "guest", "label", "shingles")), strict=True):
            if (region, i, j) != key:
                close()
                key = (region, i, j)
            sides[guest][0].append(np.frombuffer(s, dtype=np.int64))
            sides[guest][1].append(label)
        yield table()
        out.clear()
    close()
    yield table()


def _joined(tasks: DataFrame) -> DataFrame:
    """What _join_regions gives for tasks (region, i, j, doc_id, label, shingles)."""
    tasks = tasks.select("region", "i", "j", "doc_id", "label", "shingles")
    return tasks.repartition("region", "i", "j").sortWithinPartitions("region", "i", "j", "doc_id").mapInArrow(lean(_join_regions), "region bigint, label bigint, lowest bigint, pivot bigint")


def _relabelled(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows with the lowest labels that found has for theirs."""
    to = maybe_broadcast(found.where("label is not null").select(F.col("region").alias("_region"), F.col("label").alias("_label"), "lowest"))
    return rows.join(to, (F.col("region") == F.col("_region")) & (F.col("label") == F.col("_label")), "left").withColumn("label", F.coalesce("lowest", "label")).drop("_region", "_label", "lowest")


def _large_regions(sets: DataFrame) -> DataFrame:
    """Rows (a, b) of documents and their components in regions of several blocks, from sets (region, doc_id, n, shingles, blocks, i)."""
    labelled = sets.select("region", "doc_id", "blocks", "i", F.col("doc_id").alias("label"))
    rows, left = sets.select("region", "doc_id", "n", "i", "blocks", "shingles", F.col("doc_id").alias("label")), sets.count()
    while True:
        found = materialise(_joined(rows.withColumn("j", F.lit(0))), "round")
        labelled = materialise(_relabelled(labelled, found), "labelled")
        single = rows.where("blocks > 1").isEmpty()
        pivots = found.where("pivot is not null").select("region", F.col("pivot").alias("doc_id"))
        before, left = left, pivots.count()
        if single or left > (1 - SHRINK) * before:
            break
        rows = sets.select("region", "doc_id", "n", "shingles").join(pivots, ["region", "doc_id"]).join(labelled.select("region", "doc_id", "label"), ["region", "doc_id"])
        whole = rows.groupBy("region").agg(F.count("*").alias("docs"), F.sum("n").alias("total"))
        rows = materialise(rows.join(maybe_broadcast(whole.select("region", _blocks().alias("blocks"))), "region").withColumn("i", F.pmod(F.xxhash64("label"), F.col("blocks")).cast("int")), "pivots")
    main = maybe_broadcast(labelled.groupBy("region", "label").count().groupBy("region").agg(F.max_by("label", F.struct("count", "label")).alias("main")))
    other = materialise(labelled.join(main, "region").where("label <> main").select("region", "doc_id", "label"), "other")
    # every block with every part of the others; few and large ones, as each document is sent to all of the other side
    size = sets.groupBy("region").agg(F.count("*").alias("docs"), F.sum("n").alias("total")).select("region", _last_blocks().alias("blocks"))
    parts = sets.select("region", "doc_id", "n").join(other, ["region", "doc_id"]).groupBy("region").agg(F.count("*").alias("docs"), F.sum("n").alias("total")).select("region", _last_blocks().alias("parts"))
    dealt = maybe_broadcast(size.join(parts, "region"))
    plain = sets.select("region", "doc_id", "shingles")
    own = plain.join(labelled.select("region", "doc_id", "label"), ["region", "doc_id"]).join(dealt, "region").withColumn("guest", F.lit(False))
    own = own.withColumns({"i": F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"), "j": F.explode(F.sequence(F.lit(0), F.col("parts") - 1))})
    guests = plain.join(other, ["region", "doc_id"]).join(dealt, "region").withColumn("guest", F.lit(True))
    guests = guests.withColumns({"j": F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("parts")).cast("int"), "i": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))})
    tasks = own.unionByName(guests).select("region", "i", "j", "guest", "label", "shingles").repartition("region", "i", "j").sortWithinPartitions("region", "i", "j", "guest")
    across = materialise(tasks.mapInArrow(lean(_compare_blocks), "region bigint, label bigint, lowest bigint"), "across")
    if not across.isEmpty():
        merged = components(across.select(F.col("label").alias("a"), F.col("lowest").alias("b")))
        labelled = labelled.join(maybe_broadcast(merged.withColumnRenamed("id", "label")), "label", "left").withColumn("label", F.coalesce("component_id", "label"))
    return labelled.select(F.col("doc_id").alias("a"), F.col("label").alias("b"))


def _blocks() -> Column:
    """Blocks of a region of docs documents with total shingles."""
    return F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")


def _last_blocks() -> Column:
    """Blocks of docs documents with total shingles for the last comparison of a region."""
    few = F.greatest(F.lit(LAST_BLOCKS), F.ceil(F.col("docs") / LAST_DOCS))
    return F.greatest(F.least(F.ceil(F.col("docs") / BLOCK_DOCS), few), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")


def join(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id) for docs (doc_id, text)."""
    spark = docs.sparkSession
    ship(spark)
    hold = spark.sparkContext.broadcast
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    described = "doc_id bigint, n int, f1 bigint, f2 bigint, win array<bigint>"
    first = materialise(docs.mapInArrow(lean(_described()), described), "sets")
    sizes = materialise(first.drop("win"), "sizes")
    crowded = materialise(first.select(F.explode("win").alias("t")).groupBy("t").count().where(F.col("count") > LEVELS[0]), "crowded")
    levels = hold([bitmap(crowded.where(F.col("count") > x), "t") for x in LEVELS])  # 8 MB each, whatever the input
    discard(first, crowded)

    # one node for each distinct set: the copy with the smallest id, with its window
    again = docs.where("doc_id is not null").mapInArrow(lean(_described(lambda: levels.value)), described).where("n > 0")
    node = again.groupBy("f1", "f2").agg(F.min(F.struct("doc_id", "n", "win")).alias("x"))
    windows = materialise(node.select("x.doc_id", "x.n", "f1", "f2", "x.win"), "windows")
    levels.destroy()
    nodes = materialise(windows.select("doc_id", "n", "f1", "f2", F.element_at("win", -1).alias("last")), "nodes")
    times = materialise(windows.select(F.explode("win").alias("t")).groupBy("t").count().where("count > 1"), "times")
    bits = hold((bitmap(times, "t"), bitmap(times.where(F.col("count") > CROWD), "t")))
    met = materialise(windows.mapInArrow(lean(_shared(lambda: bits.value)), "t bigint, doc_id bigint, n int, crowd boolean"), "regions")
    bits.destroy()
    discard(windows, times)

    # small regions: pairs that share enough pivots
    a, b = (met.where("not crowd").select("t", F.col("doc_id").alias(x), F.col("n").alias(f"n_{x}")) for x in "ab")
    pairs = a.join(b, "t").where("a < b and 4 * n_a >= 3 * n_b and 4 * n_b >= 3 * n_a").groupBy("a", "b").agg(F.count("*").alias("shared"))
    of_crowd = met.where("crowd").groupBy("doc_id").agg(F.count("*").alias("crowd"))
    meta = nodes.select("doc_id", "n", "last").join(of_crowd, "doc_id", "left").na.fill(0, ["crowd"])
    ma, mb = (meta.select(*(F.col(c).alias(x if c == "doc_id" else f"{c}_{x}") for c in meta.columns)) for x in "ab")
    # beyond the last pivot of the document whose window ends first, at most its remaining shingles can be shared
    rest = F.when(F.col("last_a") <= F.col("last_b"), F.expr("n_a - n_a div 4 - 1")).otherwise(F.expr("n_b - n_b div 4 - 1"))
    near = pairs.join(ma, "a").join(mb, "b").where(7 * (F.col("shared") + F.least("crowd_a", "crowd_b") + rest) >= 3 * (F.col("n_a") + F.col("n_b")))

    # crowded regions: their documents stay together, tied to the smallest of their part, and those to the smallest of all
    crowd = met.where("crowd").select("t", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"), "doc_id")
    low = crowd.groupBy("t", "salt").agg(F.min("doc_id").alias("b"))
    within = crowd.join(low, ["t", "salt"]).select(F.col("doc_id").alias("a"), "b")
    across = low.join(low.groupBy("t").agg(F.min("b").alias("lowest")), "t").select(F.col("b").alias("a"), F.col("lowest").alias("b"))
    ties = within.union(across).where("a <> b").distinct()
    linked = components(near.select("a", "b").union(ties)).withColumnsRenamed({"id": "doc_id", "component_id": "region"})

    linked = materialise(linked.join(nodes.select("doc_id", "n", "f1", "f2"), "doc_id"), "second")
    discard(met)
    wanted = hold(bitmap(linked, "doc_id"))
    full = docs.where("doc_id is not null").mapInArrow(lean(_full_sets(lambda: wanted.value)), "doc_id bigint, f1 bigint, f2 bigint, shingles binary")
    whole = linked.groupBy("region").agg(F.count("*").alias("docs"), F.sum("n").alias("total"))
    linked = linked.join(maybe_broadcast(whole.select("region", _blocks().alias("blocks"))), "region").withColumn("i", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    sets = materialise(full.join(linked, ["doc_id", "f1", "f2"]).dropDuplicates(["doc_id"]).select("region", "doc_id", "n", "shingles", "blocks", "i"), "full")
    wanted.destroy()
    small = sets.where("blocks = 1").withColumns({"j": F.lit(0), "label": F.col("doc_id")})
    final = _joined(small).where("label is not null").select(F.col("label").alias("a"), F.col("lowest").alias("b"))
    large = sets.where("blocks > 1")
    if not large.isEmpty():
        final = final.union(_large_regions(large))
    final = final.select(F.col("a").alias("id"), F.col("b").alias("component_id"))

    by_set = nodes.select("f1", "f2", "doc_id").join(final.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("f1", "f2", F.coalesce("component_id", "doc_id").alias("component_id"))
    out = sizes.join(by_set, ["f1", "f2"], "left")
    return out.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).otherwise(F.col("doc_id")).alias("component_id"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(read_table(spark, sf_dir, "documents"))


def op9_sql() -> str:
    """The same by brute force: every pair of documents that shares a shingle, and the transitive closure of the links."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
    WITH RECURSIVE raw AS (
        SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
        FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < {WORDS} THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - {WORDS} + 2), lambda i: array_to_string(w[i : i + {WORDS - 1}], ' ')) END) AS s
        FROM raw WHERE len(w) > 0),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (
        SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * both_n >= 75 * (x.n + y.n - both_n)),
    reach(node, root) AS (SELECT DISTINCT a, a FROM links UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node),
    roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(root, doc_id) AS component_id
    FROM raw LEFT JOIN sizes USING (doc_id) LEFT JOIN roots ON roots.node = doc_id"""
