"""N-gram Jaccard join as a blocked sparse matrix product.

Rows of the incidence matrix are distinct shingle sets, columns are shingles
(64-bit hashes of five words). Two rows link when 100 * overlap >= 75 * union.

1. Every document is read into its set; equal sets are one row from then on, so
   copies are never compared with each other.
2. Columns are put into one total order: shingles of many rows last, by their
   counts over all documents, the rest by hash. A row takes part in the columns of
   its prefix alone: two rows that link share a column among the first
   n - ceil(0.75 n) + 1 of each, in any order. These entries travel as packed
   blocks of columns.
3. A column of at most DENSE rows marks the cells of the product that its rows and
   the places in their prefixes leave room for; sizes and a histogram of the hashes,
   which bounds the overlap from above, discard most of them. The cells left are
   accumulated block by block: rows with their partners, all columns at once.
4. A longer column marks no cells one by one. Rows that such columns connect form a
   dense group; it is cut into tiles of bounded content, by size, as rows that link
   have sizes of one class or of neighbours. Each pair of tiles is one block of the
   product, accumulated in full inside a task, and hands on no pairs: a row's number
   of links, and a forest that spans the links of the block. So what is sent grows
   with a group's rows, while every link is found and counted.

Components are those of the links found in 3 and the forests of 4.

Two sets are one row if 128 bits of their hash agree; 64 of these name it, and
should two rows ever share a name, everything is done again under another seed. Set
elements are compared as 48 bits of their hash when overlaps are counted; the
chance that this changes a count is about n^2 / 2^48 a pair.

Edge cases: null and empty texts, or texts of blanks, have no shingle and link
with nothing, their component is their own id. Texts with fewer than five words
have one shingle. Repeated rows fall into one component. Null ids never name a
component unless it has no other. Texts are read whole; a very long one is a row
with many entries, and a tile of its own where it exceeds one. An empty table gives
an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import discard, gather_bits, join_hot, lean, most_counted, shuffle_partitions, staged, table, text_bytes, trim
from tidemark.sources.ship import ship

WORDS, NUMERATOR, DENOMINATOR = 5, 75, 100
#: Columns of more rows make dense groups; their pairs are never listed.
DENSE = 64
#: A shingle seen in so many sets comes late in the order; at most so many get a place of their own.
FREQUENT, MOST_FREQUENT = 8, 1 << 18
#: Columns that are known to have so many rows go to the dense groups without being gathered in one task.
HOT_ROWS = 1 << 20
#: Entries that a block of columns, elements and rows that a tile, and partners that a row of the product should hold.
BLOCK_ENTRIES, TILE_ELEMENTS, TILE_ROWS, HUB_PARTNERS = 2_000_000, 2_000_000, 2048, 512
#: Columns and cells that a tile's product takes at a time, and rows that are judged at a time: what a worker holds beside a tile's entries and its cells.
DENSE_COLUMNS, SPARSE_CELLS, LINKED_ROWS = 512, 1_000_000, 256
#: Elements for each cell of the histogram that bounds overlaps.
PER_CELL = 2
#: Bits of the filter that picks candidate rows on the last reading, for each row and at most.
FILTER_PER_ROW, MOST_FILTER_BITS = 16, 1 << 28

_ODD = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _table(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, n, np.uint64)


#: A random number for each byte; a word's hash is a polynomial over them, taken
#: for all words at once from prefix sums.
_BYTE = _table(5, 256)
_BASE = 0x5851F42D4C957F2D
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grow_powers(n: int) -> None:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(32)
    x *= _ODD[1]
    x ^= x >> np.uint64(29)
    return x


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) < 1 << 20):
            size += len(texts[j]) + 1
            j += 1
        yield from _shingle_sets(texts[i:j])
        i = j


def _shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    # bytes.lower knows A-Z only
    chars = np.frombuffer(b" ".join(texts).lower() + b" ", np.uint8)
    _grow_powers(max(1 << 20, len(chars) + 1))
    edges = np.diff(np.concatenate(([True], _BLANK[chars])).view(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[chars] * _powers[0][: len(chars)])))
    words = _mixed((sums[ends] - sums[starts]) * _powers[1][starts])
    full = np.full(max(0, len(words) - WORDS + 1), WORDS, np.uint64)
    for k in range(WORDS if len(full) else 0):
        full = (full + words[k : k + len(full)]) * _ODD[k % len(_ODD)]
        full ^= full >> np.uint64(29)
    bounds = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if last - first >= WORDS:
            yield _distinct(full[first : last - WORDS + 1])
        elif last == first:
            yield np.zeros(0, np.uint64)
        else:
            x = np.uint64(last - first)
            with np.errstate(over="ignore"):
                for k in range(last - first):
                    x = (x + words[first + k]) * _ODD[k]
                    x ^= x >> np.uint64(29)
            yield np.array([x], np.uint64)


def set_ids(s: np.ndarray, seed: int) -> tuple[int, int]:
    """128 bits that name a set, as two signed 64-bit numbers; the first is its name."""
    h = xxhash.xxh3_128_intdigest(s.tobytes(), seed)
    return (h & 0xFFFFFFFFFFFFFFFF) - (1 << 63), (h >> 64) - (1 << 63)


def prefix_length(n: int | np.ndarray) -> int | np.ndarray:
    return n - -(-NUMERATOR * n // DENOMINATOR) + 1


def in_order(s: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The prefix of a set in the total order of shingles, and the known counts of its shingles."""
    p = prefix_length(len(s))
    if not len(frequent):
        return s[:p], np.zeros(p, np.int64)
    at = np.searchsorted(frequent, s)
    at[at == len(frequent)] = 0
    weight = np.where(frequent[at] == s, counts[at], 0)
    if not weight.any():
        return s[:p], weight[:p]
    order = np.lexsort((s, weight))[:p]
    return s[order], weight[order]


def least_overlap(n: np.ndarray, k: np.ndarray) -> np.ndarray:
    """What two rows of n and k elements must have in common to link."""
    return -(-NUMERATOR * (n + k) // (NUMERATOR + DENOMINATOR))


def sized(n: np.ndarray, k: np.ndarray) -> np.ndarray:
    return np.minimum(n, k) * DENOMINATOR >= NUMERATOR * np.maximum(n, k)


def histogram(s: np.ndarray) -> bytes:
    """Elements by the leading bits of their hash, about PER_CELL in each cell. Nothing where
    a cell overflows; then it bounds nothing."""
    bits = max(0, int(np.log2(max(1, len(s) / PER_CELL))))
    counts = np.bincount((s >> np.uint64(63 - bits) >> np.uint64(1)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max(initial=0) < 256 else b""


def most_overlap(a: bytes, b: bytes, n: int, k: int) -> int:
    """An upper bound of the overlap, from the histograms of sets of n and k elements."""
    if not a or not b:
        return min(n, k)
    x, y = np.frombuffer(a, np.uint8).astype(np.int64), np.frombuffer(b, np.uint8).astype(np.int64)
    if len(x) > len(y):
        x = x.reshape(len(y), -1).sum(1)
    elif len(y) > len(x):
        y = y.reshape(len(x), -1).sum(1)
    return int(np.minimum(x, y).sum())


def _read_rows(docs: DataFrame, seed: int) -> DataFrame:
    """For every document doc_id, key, n, s, s2 and, once for each set and task, cells (its
    histogram); beside these rows g, c: counts of the shingles that a stretch of documents
    holds several times (they steer the order of columns, that is speed; any order gives
    the same links)."""
    names = ["doc_id", "key", "n", "s", "s2", "cells", "g", "c"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()
        size = 0

        def flush() -> pa.RecordBatch:
            g, c = np.unique(np.concatenate([*held, np.zeros(0, np.uint64)]), return_counts=True)
            many = c >= 2
            nulls = [pa.nulls(int(many.sum()), t) for t in (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary())]
            return pa.RecordBatch.from_arrays([*nulls, pa.array(g[many].view(np.int64)), pa.array(c[many])], names)

        for batch in batches:
            n, own, cells = [], [], []
            for s in shingle_sets(batch.column(1).to_pylist()):
                n.append(len(s))
                own.append(set_ids(s, seed) if len(s) else (None, None))
                cells.append(None)
                if len(s) and own[-1][0] not in seen:
                    cells[-1] = histogram(s)
                    seen.add(own[-1][0])
                    held.append(s)
                    size += len(s)
                if size > 4_000_000:
                    yield flush()
                    held, size = [], 0
                    if len(seen) > 1_000_000:
                        seen.clear()
            ids = [pa.array([o[i] for o in own], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64()), *ids, pa.array(cells, pa.binary()), pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.int64())], names)
        yield flush()

    return docs.mapInArrow(lean(run), "doc_id long, key string, n long, s long, s2 long, cells binary, g long, c long")


#: Entries of a column: shingle, row, size of the row, place in its prefix.
_G, _S, _N, _POS = range(4)


def _planes(x: np.ndarray) -> bytes:
    """Bytes by their place in the number, so that leading zeros lie together and pack well."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes()


def pack_entries(rows: np.ndarray) -> bytes:
    """Entries (fields by entries), sorted by shingle, of which differences are kept."""
    steps = np.diff(rows[_G].view(np.uint64), prepend=np.uint64(0))
    return b"".join((_planes(steps), _planes(rows[_S]), _planes(rows[_N].astype(np.uint32)), _planes(rows[_POS].astype(np.uint32))))


def unpack_entries(data: bytes) -> np.ndarray:
    k = len(data) // 24
    flat = np.frombuffer(data, np.uint8)
    part = lambda at, width, kind: np.ascontiguousarray(flat[at * k : (at + width) * k].reshape(width, k).T).view(kind).ravel()
    return np.stack([np.cumsum(part(0, 8, np.uint64)).view(np.int64), part(8, 8, np.int64), part(16, 4, np.uint32).astype(np.int64), part(20, 4, np.uint32).astype(np.int64)])


def _entries(docs: DataFrame, frequent: np.ndarray, counts: np.ndarray, blocks: int, seed: int) -> DataFrame:
    """The prefixes of all rows as packed blocks of columns: block, entries. The entries of
    columns that are known to be hot come one by one: s, g."""
    shared = docs.sparkSession.sparkContext.broadcast((frequent, counts))
    chunk = min(4_000_000, max(1_000_000, 100 * blocks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, weights = shared.value
        seen: set[int] = set()
        held: list[np.ndarray] = []
        hot: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            rows = np.concatenate([*held, np.zeros((4, 0), np.int64)], axis=1)
            rows = rows[:, np.argsort(rows[_G].view(np.uint64))]
            place = ((rows[_G].view(np.uint64) >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)
            starts = np.flatnonzero(np.diff(place, prepend=-1))
            bounds = [*starts.tolist(), len(place)]
            packed = [pack_entries(rows[:, i:j]) for i, j in zip(bounds, bounds[1:], strict=False)]
            alone = np.concatenate([*hot, np.zeros((2, 0), np.int64)], axis=1)
            k, m = len(packed), alone.shape[1]
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays([pa.array(place[starts], pa.int64()), pa.nulls(m, pa.int64())]), pa.array(packed + [None] * m, pa.binary()), *(pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(x)]) for x in alone)],
                ["block", "entries", "s", "g"],
            )

        for batch in batches:
            for s in shingle_sets(batch.column(0).to_pylist()):
                if not len(s) or (own := set_ids(s, seed)[0]) in seen:
                    continue
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(own)
                prefix, weight = in_order(s, often, weights)
                rows = np.stack([prefix.view(np.int64), np.full(len(prefix), own), np.full(len(prefix), len(s)), np.arange(len(prefix))])
                cold = weight < HOT_ROWS
                if not cold.all():
                    hot.append(rows[[_S, _G]][:, ~cold])
                    rows = rows[:, cold]
                held.append(rows)
                size += len(prefix)
                if size > chunk:
                    yield flush()
                    held, hot, size = [], [], 0
        yield flush()

    return docs.select("text").mapInArrow(lean(run), "block long, entries binary, s long, g long")


def columns_of(rows: np.ndarray, dense: int) -> Iterator[tuple[np.ndarray, bool]]:
    """Entries in any order, as columns of two rows or more: all of one length at a time as
    (fields, columns, rows), and whether they are dense, that is of more rows. A set that came from several tasks counts once."""
    order = np.lexsort((rows[_S], rows[_G]))
    rows = rows[:, order]
    again = (rows[_G, 1:] == rows[_G, :-1]) & (rows[_S, 1:] == rows[_S, :-1])
    if again.any():
        rows = rows[:, np.concatenate(([True], ~again))]
    starts = np.concatenate(([0], np.flatnonzero(np.diff(rows[_G])) + 1, [rows.shape[1]]))
    sizes = np.diff(starts)
    for size in np.unique(sizes[sizes > 1]).tolist():
        of_size = starts[:-1][sizes == size]
        step = max(1, 2_000_000 // (size * min(size, dense)))
        for i in range(0, len(of_size), step):
            yield rows[:, of_size[i : i + step, None] + np.arange(size)], size > dense


def marked_cells(columns: np.ndarray) -> np.ndarray:
    """The pairs (a < b) of rows that a column leaves room for: if it is their first common
    one, at most what stands from it on is common."""
    i, j = np.triu_indices(columns.shape[2], 1)
    a, b = columns[:, :, i], columns[:, :, j]
    behind = np.minimum(a[_N] - a[_POS], b[_N] - b[_POS])
    fits = sized(a[_N], b[_N]) & (behind >= least_overlap(a[_N], b[_N]))
    s, t = a[_S][fits], b[_S][fits]
    return np.stack([np.minimum(s, t), np.maximum(s, t)])


def _distinct_pairs(parts: list[np.ndarray]) -> np.ndarray:
    pairs = np.concatenate([*parts, np.zeros((2, 0), np.int64)], axis=1)
    pairs = pairs[:, np.lexsort((pairs[1], pairs[0]))]
    return pairs[:, np.concatenate(([True], (np.diff(pairs) != 0).any(0)))] if pairs.shape[1] else pairs


def _cells(entries: DataFrame) -> DataFrame:
    """a, b: cells to accumulate; or s, g: the rows of a dense column."""
    names, most = ["a", "b", "s", "g"], DENSE

    def result(cells: np.ndarray, dense: np.ndarray) -> pa.RecordBatch:
        k, m = cells.shape[1], dense.shape[1]
        return pa.RecordBatch.from_arrays([*(pa.concat_arrays([pa.array(x), pa.nulls(m, pa.int64())]) for x in cells), *(pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(x)]) for x in dense)], names)

    def block(parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        cells, dense, size = [], [np.zeros((2, 0), np.int64)], 0
        for columns, is_dense in columns_of(np.concatenate([unpack_entries(p) for p in parts], axis=1), most):
            if is_dense:
                dense.append(columns[[_S, _G]].reshape(2, -1))
                continue
            cells.append(marked_cells(columns))
            size += cells[-1].shape[1]
            if size > 4_000_000:
                cells, size = [_distinct_pairs(cells)], 0
                if cells[0].shape[1] > 2_000_000:
                    yield result(cells.pop(), np.zeros((2, 0), np.int64))
        yield result(_distinct_pairs(cells), np.concatenate(dense, axis=1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, parts = None, []
        for batch in batches:
            for number, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if number != own:
                    if parts:
                        yield from block(parts)
                    own, parts = number, []
                parts.append(packed)
        if parts:
            yield from block(parts)

    dealt = entries.where("block is not null").select("block", "entries").repartition("block").sortWithinPartitions("block")
    return dealt.mapInArrow(lean(run), "a long, b long, s long, g long")


def _candidates(docs: DataFrame, wanted: DataFrame, seed: int) -> DataFrame:
    """s, n, elements (6 bytes each) of the rows in ``wanted`` (s, distinct), from one more reading. A bit filter of bounded size picks them; where it
    lets others through, the join drops them."""
    n_wanted, bits = wanted.count(), 1 << 18
    while bits < min(FILTER_PER_ROW * n_wanted, MOST_FILTER_BITS):
        bits *= 2
    shared = docs.sparkSession.sparkContext.broadcast(gather_bits(wanted.select(F.col("s").bitwiseAND(F.lit(bits - 1)).alias("bit")), bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        picked, seen = shared.value, set()
        for batch in batches:
            own, n, packed = [], [], []
            for s in shingle_sets(batch.column(0).to_pylist()):
                if not len(s):
                    continue
                bit = (i := set_ids(s, seed)[0]) & (bits - 1)
                if int(picked[bit >> 6]) >> (bit & 63) & 1 and i not in seen:
                    if len(seen) > 1_000_000:
                        seen.clear()
                    seen.add(i)
                    own.append(i)
                    n.append(len(s))
                    packed.append(s.view(np.uint8).reshape(-1, 8)[:, 2:].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(n, pa.int64()), pa.array(packed, pa.binary())], ["s", "n", "elements"])

    found = docs.select("text").mapInArrow(lean(run), "s long, n long, elements binary")
    return found.join(wanted, "s", "left_semi").dropDuplicates(["s"])


def unpacked(elements: bytes) -> np.ndarray:
    """Sorted as packed: the high six bytes of a little-endian number, as numbers below 2^48."""
    out = np.zeros((len(elements) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(elements, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _bounded(cells: DataFrame, rows: DataFrame) -> DataFrame:
    """The cells whose rows' histograms leave room for a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n, k, x, y = (c.to_pylist() for c in batch.columns)
            least = least_overlap(np.array(n, np.int64), np.array(k, np.int64)).tolist()
            keep = pa.array([most_overlap(x[i], y[i], n[i], k[i]) >= least[i] for i in range(len(a))], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    side = lambda c, n, x: rows.select(F.col("s").alias(c), F.col("n").alias(n), F.col("cells").alias(x))
    both = cells.join(side("a", "na", "xa"), "a").join(side("b", "nb", "xb"), "b")
    return both.select("a", "b", "na", "nb", "xa", "xb").mapInArrow(lean(run), "a long, b long")


def masked_overlaps(hubs: list[np.ndarray], partners: list[np.ndarray], owner: np.ndarray) -> np.ndarray:
    """One block of the product, at the marked cells: the overlap of each partner with the
    hub ``owner`` names, accumulated over all columns at once. At most 2^16 hubs."""
    shift = np.uint64(48)
    own = np.concatenate([h + (np.uint64(i) << shift) for i, h in enumerate(hubs)])
    lengths = np.array([len(p) for p in partners])
    other = np.concatenate(partners) + (np.repeat(owner.astype(np.uint64), lengths) << shift)
    at = np.searchsorted(own, other)
    at[at == len(own)] = 0
    return np.add.reduceat((own[at] == other).astype(np.int64), np.cumsum(lengths) - lengths)


def _links(cells: DataFrame, rows: DataFrame) -> DataFrame:
    """The marked cells that link. A row with many partners is sent to several tasks."""
    degree = cells.groupBy("a").agg(F.count("*").alias("degree"))
    parts = F.ceil(F.col("degree") / HUB_PARTNERS)
    salted = cells.join(degree, "a").select("a", "b", F.pmod(F.xxhash64("b"), parts).alias("salt"))
    partners = salted.join(rows, F.col("b") == F.col("s")).select("a", "salt", "b", "n", "elements")
    salts = degree.select("a", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("salt"))
    hubs = salts.join(rows, F.col("a") == F.col("s")).select("a", "salt", F.lit(None).cast("long").alias("b"), "n", "elements")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, sizes, sets = [], [], []  # of the hubs of a block; the last one may go on in the next
        for batch in batches:
            a, b, n, elements = (batch.column(i).to_pylist() for i in (0, 2, 3, 4))
            low = 0
            while low < len(a):
                owner, own_b, own_n, others, size = [], [], [], [], 0
                while low < len(a) and (size < 2_000_000 or not others) and len(sets) < 1 << 16:
                    row = unpacked(elements[low])
                    size += len(row)
                    if b[low] is None:
                        names.append(a[low])
                        sizes.append(n[low])
                        sets.append(row)
                    else:
                        if not names or a[low] != names[-1]:
                            raise ValueError("a row's own set is missing")
                        owner.append(len(names) - 1)
                        own_b.append(b[low])
                        own_n.append(n[low])
                        others.append(row)
                    low += 1
                if others:
                    at = np.array(owner)
                    overlap, total = masked_overlaps(sets, others, at), np.array(sizes)[at] + np.array(own_n)
                    link = DENOMINATOR * overlap >= NUMERATOR * (total - overlap)
                    yield pa.RecordBatch.from_arrays([pa.array(np.array(names)[at][link]), pa.array(np.array(own_b)[link])], ["a", "b"])
                names, sizes, sets = names[-1:], sizes[-1:], sets[-1:]

    dealt = partners.unionByName(hubs).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return dealt.mapInArrow(lean(run), "a long, b long")


def block_product(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Overlap counts of all rows of one tile with all of another. Columns that many rows
    share go through a dense product, a few thousand at a time; the others add their
    cells one by one."""
    shape = (len(left), len(right))
    if sum(shape) > 1 << 16:
        at = max(shape) // 2
        if shape[0] >= shape[1]:
            return np.concatenate([block_product(left[:at], right), block_product(left[at:], right)])
        return np.concatenate([block_product(left, right[:at]), block_product(left, right[at:])], axis=1)
    out = np.zeros(shape, np.float32)
    # one number an entry: 48 bits of the element, then the row, those of the left first
    entries = np.concatenate([*left, *right]) << np.uint64(16)
    entries |= np.repeat(np.arange(sum(shape), dtype=np.uint64), [len(x) for t in (left, right) for x in t])
    entries.sort()
    rows = entries.astype(np.uint16)
    entries >>= np.uint64(16)
    starts = np.flatnonzero(np.concatenate(([True], entries[1:] != entries[:-1])))
    del entries
    n_right = np.add.reduceat(rows >= shape[0], starts, dtype=np.int64)
    n_left = np.diff(np.append(starts, len(rows))) - n_right
    both = (n_left > 0) & (n_right > 0)
    starts, n_left, n_right = starts[both], n_left[both], n_right[both]
    dense = n_left * n_right * 64 > shape[0] * shape[1]
    at = np.flatnonzero(dense)
    for low in range(0, len(at), DENSE_COLUMNS):
        part = at[low : low + DENSE_COLUMNS]
        sides = []
        for first, count, size, ahead in ((starts[part], n_left[part], shape[0], 0), (starts[part] + n_left[part], n_right[part], shape[1], shape[0])):
            m = np.zeros((size, len(part)), np.float32)
            column = np.repeat(np.arange(len(part)), count)
            m[rows[np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())] - np.int64(ahead), column] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    at, low = np.flatnonzero(~dense), 0
    work = np.cumsum(n_left[at] * n_right[at])
    while low < len(at):
        high = max(low + 1, int(np.searchsorted(work, (work[low - 1] if low else 0) + SPARSE_CELLS, "right")))
        part = at[low:high]
        n, k = n_left[part], n_right[part]
        first = rows[np.repeat(starts[part] - np.cumsum(n) + n, n) + np.arange(n.sum())].astype(np.int64)  # the left entries, column by column
        times = np.repeat(k, n)
        ends = np.cumsum(times)
        second = rows[np.arange(ends[-1]) + np.repeat(np.repeat(starts[part] + n, n) - ends + times, times)] - np.int64(shape[0])
        out += np.bincount(np.repeat(first, times) * shape[1] + second, minlength=shape[0] * shape[1]).reshape(shape)
        low = high
    return out.astype(np.int32)


def linked(overlap: np.ndarray, n: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Which rows, of n elements, link with which columns, of k: some rows at a time."""
    out = np.zeros(overlap.shape, bool)
    for i in range(0, len(n), LINKED_ROWS):
        common = overlap[i : i + LINKED_ROWS].astype(np.int64)
        out[i : i + LINKED_ROWS] = DENOMINATOR * common >= NUMERATOR * (n[i : i + LINKED_ROWS, None] + k - common)
    return out


def forest(link: np.ndarray, same: bool) -> tuple[list[int], list[int]]:
    """Those of a block's links (left, right) that a spanning forest needs; same: its rows are its columns."""
    out: tuple[list[int], list[int]] = ([], [])
    fresh = [np.ones(n, bool) for n in link.shape]
    if same:
        fresh[1] = fresh[0]
    for start in np.flatnonzero(link.any(1)).tolist():
        if not fresh[0][start]:
            continue
        fresh[0][start] = False
        stack = [(0, start)]
        while stack:
            side, at = stack.pop()
            found = np.flatnonzero((link[at] if side == 0 else link[:, at]) & fresh[1 - side])
            fresh[1 - side][found] = False
            for x in found.tolist():
                out[side].append(at)
                out[1 - side].append(x)
                stack.append((0 if same else 1 - side, x))
    return out


def _tiles(groups: DataFrame, rows: DataFrame, copies: DataFrame) -> DataFrame:
    """groups: s, label. The product of each dense group: s, others (documents of the rows
    that a row links with) and a, b (a forest of the links), from pairs of tiles."""
    width = float(np.log(DENOMINATOR / NUMERATOR) * (1 + 1e-9))
    # what one tile holds; a group that it holds needs no classes
    tiles = F.greatest(F.ceil(F.sum("n") / TILE_ELEMENTS), F.ceil(F.count("*") / TILE_ROWS)).alias("parts")
    labelled = groups.join(rows.select("s", "n"), "s")
    whole = labelled.groupBy("label").agg(tiles).select("label", (F.col("parts") == 1).alias("whole"))
    sized_rows = labelled.join(whole, "label").select("s", "label", F.when(F.col("whole"), -1).otherwise(F.floor(F.log(F.col("n")) / width)).alias("class"), "n")
    shares = sized_rows.groupBy("label", "class").agg(tiles)
    # rows that link are of one class or of neighbours: each class meets itself and the next
    after = shares.select("label", (F.col("class") - 1).alias("class"), F.col("parts").alias("parts_after"))
    before = shares.select("label", (F.col("class") + 1).alias("class"), F.col("parts").alias("parts_before"))
    around = shares.join(after, ["label", "class"], "left").join(before, ["label", "class"], "left")
    placed = sized_rows.drop("n").join(around, ["label", "class"]).withColumn("tile", F.pmod(F.xxhash64("s"), F.col("parts")))
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<bigint>"))
    block = lambda low, i, high, j, side: F.struct(low.cast("long").alias("low"), i.cast("long").alias("i"), high.cast("long").alias("high"), j.cast("long").alias("j"), F.lit(side).alias("side"))
    own, tile = F.col("class"), F.col("tile")
    inside = F.transform(upto(F.col("parts")), lambda j: F.when(j < tile, block(own, j, own, tile, 1)).otherwise(block(own, tile, own, j, 0)))
    upward = F.transform(upto(F.coalesce("parts_after", F.lit(0))), lambda j: block(own, tile, own + 1, j, 0))
    downward = F.transform(upto(F.coalesce("parts_before", F.lit(0))), lambda j: block(own - 1, j, own, tile, 1))
    dealt = placed.select("s", "label", F.explode(F.concat(inside, upward, downward)).alias("at")).select("s", "label", "at.*")
    full = dealt.join(rows.select("s", "n", "elements").join(copies, "s"), "s")

    def product(rows_of: pa.Table) -> pa.Table:
        low, i, high, j = (rows_of.column(c)[0].as_py() for c in ("low", "i", "high", "j"))
        same = (low, i) == (high, j)
        order = np.argsort(rows_of.column("s").to_numpy())
        s, n, times, side = (rows_of.column(c).to_numpy()[order] for c in ("s", "n", "copies", "side"))
        sets = [unpacked(e) for e in rows_of.column("elements").take(pa.array(order)).to_pylist()]
        left, right = (np.flatnonzero(side == k) for k in (0, 1))
        if same:
            right = left
        others, links = np.zeros(len(s), np.int64), ([], [])
        if len(left) and len(right):
            link = linked(block_product([sets[x] for x in left], [sets[x] for x in right]), n[left], n[right])
            if same:
                np.fill_diagonal(link, False)
            for at in range(0, len(left), LINKED_ROWS):
                some = left[at : at + LINKED_ROWS]
                others[some] += link[at : at + LINKED_ROWS] @ times[right]
                if not same:
                    others[right] += link[at : at + LINKED_ROWS].T @ times[some]
            x, y = forest(link, same)
            links = (s[left[x]], s[right[y]])
        del sets
        trim()
        some, k = np.flatnonzero(others), len(links[0])
        counted = [pa.array(s[some]), pa.array(others[some])]
        return pa.table([*(pa.concat_arrays([c, pa.nulls(k, pa.int64())]) for c in counted), *(pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(c, pa.int64())]) for c in links)], ["s", "others", "a", "b"])

    return full.groupBy("label", "low", "i", "high", "j").applyInArrow(product, "s long, others long, a long, b long")


def components(links: DataFrame) -> DataFrame:
    """s, comp (the least s that links reach) of every end of a link, by alternating large
    and small stars until only stars are left; each step is a table in the shared folder."""
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "stars")
    while not edges.select("u", F.lit(0).alias("inner")).unionByName(edges.select(F.col("v").alias("u"), F.lit(1).alias("inner"))).groupBy("u").agg(F.count_if(F.col("inner") == 0).alias("n"), F.max("inner").alias("inner")).where("n > 1 or n = 1 and inner = 1").isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        last, edges = edges, staged(small, "stars")
        discard(last)
    return edges.select(F.col("u").alias("s"), F.col("v").alias("comp")).unionByName(edges.select(F.col("v").alias("s"), F.col("v").alias("comp")).distinct())


def jaccard_join(docs: DataFrame, key: Column | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links, first, key of every row of docs (doc_id, text).
    n_links: the other rows that a row links with, copies of its text among them. first:
    whether the row's id is its component's (of repeated rows, all are); among rows with
    that id those with the least ``key`` are, which tells rows of one id apart."""
    spark = docs.sparkSession
    ship(spark)
    key = F.lit(None) if key is None else key
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"), key.cast("string").alias("key"))
    seed = 0
    while True:
        read = staged(_read_rows(rows, seed), "jaccard-rows")
        sets = read.where("c is null").drop("g", "c")
        own = staged(sets.where("s is not null").groupBy("s").agg(F.count("*").alias("copies"), F.max("n").alias("n"), F.min("s2").alias("least"), F.max("s2").alias("most")), "jaccard-sets")
        if own.where("least <> most").isEmpty():
            break
        discard(read, own)
        seed += 1
    copies = own.select("s", "copies")
    often = most_counted(read.where("c is not null").groupBy("g").agg(F.sum("c").alias("c")).where(F.col("c") >= FREQUENT), "g", MOST_FREQUENT)
    g = np.array([x for x, _ in often], np.int64).view(np.uint64)
    order = np.argsort(g)
    total = own.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocks = max(4 * shuffle_partitions(spark), prefix_length(total) // BLOCK_ENTRIES)
    entries = _entries(rows, g[order], np.array([c for _, c in often], np.int64)[order], blocks, seed)
    hot = F.col("s").isNotNull()
    if len(often) and often[0][1] >= HOT_ROWS:  # then some entries are read twice, as blocks and alone
        entries = staged(entries, "jaccard-entries")
        found = staged(_cells(entries).unionByName(entries.where(hot).select("s", "g"), allowMissingColumns=True), "jaccard-cells")
        discard(entries)
    else:
        found = staged(_cells(entries), "jaccard-cells")
    cells, dense = found.where("a is not null").select("a", "b").distinct(), found.where(hot).select("s", "g")
    has_dense = not dense.isEmpty()
    if has_dense:
        # a shingle is a node beside the rows; should it share a row's name, groups are united, which costs time alone
        groups = staged(components(dense.select(F.col("s").alias("a"), F.bitwise_not("g").alias("b"))).join(dense.select("s").distinct(), "s", "left_semi").select("s", F.col("comp").alias("label")), "jaccard-groups")
        label = lambda c: groups.select(F.col("s").alias(c), F.col("label").alias(f"label_{c}"))
        cells = cells.join(label("a"), "a", "left").join(label("b"), "b", "left").where("not (label_a <=> label_b) or label_a is null").select("a", "b")
    cells = staged(cells, "jaccard-marked")
    bounded = staged(_bounded(cells, sets.where("cells is not null").select("s", "n", "cells").dropDuplicates(["s"])), "jaccard-bounded")
    wanted = bounded.select(F.explode(F.array("a", "b")).alias("s"))
    if has_dense:
        wanted = wanted.unionByName(groups.select("s"))
    candidates = staged(_candidates(rows, staged(wanted.distinct(), "jaccard-wanted"), seed), "jaccard-candidates")
    links = staged(_links(bounded, candidates), "jaccard-links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(copies, F.col("b") == F.col("s")).select(F.col("a").alias("s"), F.col("copies").alias("others"))
    if has_dense:
        tiled = staged(_tiles(groups, candidates, copies), "jaccard-tiles")
        others = others.unionByName(tiled.where("s is not null").select("s", "others"))
        links = links.unionByName(tiled.where("a is not null").select("a", "b"))
    labels = staged(components(links), "jaccard-labels")
    discard(found, cells, bounded, candidates)
    of_set = copies.join(others.groupBy("s").agg(F.sum("others").alias("others")), "s", "left").join(labels, "s", "left")
    of_set = staged(of_set.select("s", "copies", F.coalesce("comp", "s").alias("comp"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")), "jaccard-classes")
    return _named(sets.drop("s2", "cells"), of_set)


def _named(sets: DataFrame, of_set: DataFrame) -> DataFrame:
    """Every document with its class, of which the least id is the name."""
    n_rows = of_set.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    named = staged(join_hot(sets, of_set, "s", "copies", n_rows), "jaccard-named")
    place = lambda: F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    classes = named.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("component_id"), F.min(place()).alias("least"), F.count("*").alias("members"))
    joined = join_hot(named, classes, "comp", "members", n_rows)
    component = F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    first = F.col("comp").isNull() | place().eqNullSafe(F.col("least"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), first.alias("first"), "key")


def op8_sparse_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")


OP8_SQL = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words from documents),
g as (select doc_id, list_distinct(case when len(words) = 0 then [] when len(words) < 5 then [array_to_string(words, ' ')]
             else list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) end) as grams from w),
n as (select doc_id, len(grams) as n_shingles from g),
e as (select doc_id, unnest(grams) as gram from g),
p as (select a.doc_id as a, b.doc_id as b, count(*) as common from e a join e b on a.gram = b.gram and a.doc_id <> b.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * common >= 75 * (x.n_shingles + y.n_shingles - common)),
r as (select doc_id as a, doc_id as b from n union select r.a, l.b from r join l on r.b = l.a),
c as (select a as doc_id, min(b) as component_id from r group by a),
d as (select a as doc_id, count(*) as n_links from l group by a)
select doc_id, cast(n_shingles as bigint) as n_shingles, component_id, cast(coalesce(n_links, 0) as bigint) as n_links from n join c using (doc_id) left join d using (doc_id)"""
