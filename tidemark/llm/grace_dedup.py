"""Exact dedup by Grace hash partitioning.

1. Every text is normalised (the six blank characters deleted) and digested; the
   digests (52 bytes a row) are written to the shared folder.
2. From the digests' sizes a partition tree is planned: a bucket of distinct
   content that would exceed ``leaf_bytes`` is split by its next digest bits,
   recursively, until each leaf fits. The tree holds one entry for each inner
   bucket, so it grows with total bytes / leaf_bytes, not with documents.
3. Records are dealt to their leaf. Spark's shuffle files are the spill files:
   they are on the executors' disks, and a lost one is made again. Before that,
   an open-addressing table in each task folds equal contents into one record,
   so a hot text crosses the network once for each task, not once for each copy.
4. A leaf's table compares complete contents, never hashes alone, and yields one
   row for each distinct content. A sort by leaf within the task keeps one leaf
   in memory at a time.

Edge cases: null counts as empty text; all texts without other characters are
equal. Of repeated rows (same id, same text) one is kept. Null ids lose every
tie. A very long text is one record, held whole by the task that compares it. An
empty table gives an empty result; other columns are not looked at. Rows of hot
texts find their group without meeting in one task. Two different contents with one SHA-256 raise ValueError: none are known.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import join_hot, lean, shuffle_partitions, staged, table, text_bytes
from tidemark.sources.ship import ship

LEAF_BYTES = 64 << 20
#: What a task's folding table may hold before it hands its records on.
FOLD_BYTES = 48 << 20
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"


def normalised(text: bytes) -> bytes:
    return text.translate(None, BLANKS)


class ContentTable:
    """Open addressing with linear probing over complete contents. hash_bits cuts
    the hash, so that tests can force collisions."""

    def __init__(self, hash_bits: int = 64) -> None:
        self._mask_hash = (1 << hash_bits) - 1
        self._slots: list[int] = [-1] * 1024
        self._hashes: list[int] = []
        self.contents: list[bytes] = []
        #: code points of the best row, its id, rows
        self.best: list[tuple[int, int | None]] = []
        self.rows: list[int] = []
        self.n_bytes = 0

    def add(self, content: bytes, n_chars: int, doc_id: int | None, rows: int) -> None:
        h = xxhash.xxh64_intdigest(content) & self._mask_hash
        mask = len(self._slots) - 1
        at = h & mask
        while (entry := self._slots[at]) >= 0:
            if self._hashes[entry] == h and self.contents[entry] == content:
                self.rows[entry] += rows
                if _beats((n_chars, doc_id), self.best[entry]):
                    self.best[entry] = (n_chars, doc_id)
                return
            at = (at + 1) & mask
        self._slots[at] = len(self.contents)
        self._hashes.append(h)
        self.contents.append(content)
        self.best.append((n_chars, doc_id))
        self.rows.append(rows)
        self.n_bytes += len(content)
        if 2 * len(self.contents) > len(self._slots):
            self._grow()

    def _grow(self) -> None:
        self._slots = [-1] * (2 * len(self._slots))
        mask = len(self._slots) - 1
        for entry, h in enumerate(self._hashes):
            at = h & mask
            while self._slots[at] >= 0:
                at = (at + 1) & mask
            self._slots[at] = entry


def _beats(a: tuple[int, int | None], b: tuple[int, int | None]) -> bool:
    """More code points, then the smaller id; a null id comes last."""
    if a[0] != b[0]:
        return a[0] > b[0]
    return a[1] is not None and (b[1] is None or a[1] < b[1])


def plan_leaves(digests: DataFrame, leaf_bytes: int, step: int = 1) -> tuple[frozenset[bytes], int]:
    """The inner buckets (digest prefixes) and the bytes of distinct content."""
    sizes = digests.groupBy("sha").agg(F.max("n_bytes").alias("n_bytes"))
    total = sizes.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    inner: set[bytes] = set()
    over, depth = ({b""} if total > leaf_bytes else set()), 0
    while over and depth < 32:
        inner |= over
        depth += step
        prefix = F.substring("sha", 1, depth)
        found = sizes.groupBy(prefix.alias("p")).agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n")).where((F.col("b") > leaf_bytes) & (F.col("n") > 1)).select("p").collect()
        over = {bytes(r.p) for r in found}
    return frozenset(inner), total


def leaf_of(sha: bytes, inner: frozenset[bytes], step: int = 1) -> bytes:
    n = 0
    while sha[:n] in inner:
        n += step
    return sha[:n]


def digest_rows(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, sha, n_bytes of every row."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [normalised(t) for t in batch.column(2).to_pylist()]
            shas = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), shas, pa.array([len(t) for t in texts], pa.int64())], ["doc_id", "n_chars", "sha", "n_bytes"])

    return docs.mapInArrow(lean(digest), "doc_id long, n_chars long, sha binary, n_bytes long")


def distinct_contents(docs: DataFrame, inner: frozenset[bytes], n_parts: int, hash_bits: int = 64) -> DataFrame:
    """sha, keep_id, group_size of every distinct content."""
    names = ["leaf", "content", "n_chars", "doc_id", "n_rows"]
    schema = "leaf binary, content binary, n_chars long, doc_id long, n_rows long"

    def records(t: ContentTable) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(t.contents), 2000):
            part = t.contents[i : i + 2000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([leaf_of(hashlib.sha256(c).digest(), inner) for c in part], pa.binary()), pa.array(part, pa.binary()), pa.array([b[0] for b in t.best[i : i + 2000]], pa.int64()), pa.array([b[1] for b in t.best[i : i + 2000]], pa.int64()), pa.array(t.rows[i : i + 2000], pa.int64())], names
            )

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = ContentTable(hash_bits)
        for batch in batches:
            for doc_id, n_chars, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                t.add(normalised(text), n_chars, doc_id, 1)
            if t.n_bytes > FOLD_BYTES:
                yield from records(t)
                t = ContentTable(hash_bits)
        yield from records(t)

    def classes(t: ContentTable) -> Iterator[pa.RecordBatch]:
        shas = [hashlib.sha256(c).digest() for c in t.contents]
        if len(set(shas)) < len(shas):
            raise ValueError("two different contents have one SHA-256")
        yield pa.RecordBatch.from_arrays([pa.array(shas, pa.binary()), pa.array([b[1] for b in t.best], pa.int64()), pa.array([b[0] for b in t.best], pa.int64()), pa.array(t.rows, pa.int64())], ["sha", "keep_id", "keep_chars", "group_size"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf, t = None, ContentTable(hash_bits)
        for batch in batches:
            for own, content, n_chars, doc_id, rows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != leaf:
                    if t.contents:
                        yield from classes(t)
                    leaf, t = own, ContentTable(hash_bits)
                t.add(content, n_chars, doc_id, rows)
        if t.contents:
            yield from classes(t)

    dealt = docs.mapInArrow(lean(fold), schema).repartition(n_parts, "leaf").sortWithinPartitions("leaf")
    return dealt.mapInArrow(lean(settle), "sha binary, keep_id long, keep_chars long, group_size long")


def exact_groups(docs: DataFrame, leaf_bytes: int = LEAF_BYTES, hash_bits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of docs (doc_id, text)."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"), text_bytes().alias("text"))
    digests = staged(digest_rows(rows).withColumn("row", F.monotonically_increasing_id()), "grace-digests")
    inner, total = plan_leaves(digests, leaf_bytes)
    n_parts = max(shuffle_partitions(spark), -(-total // leaf_bytes))
    # of repeated rows of the id that stays, one stays: the least row, as an aggregate
    least = F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("least")
    groups = distinct_contents(rows, inner, n_parts, hash_bits).join(digests.groupBy("sha").agg(least), "sha")
    groups = staged(groups.select("sha", "keep_id", "group_size", F.col("least.row").alias("keep_row")), "grace-groups")
    joined = join_hot(digests, groups, "sha", "group_size", digests.count())
    return joined.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def op3_grace_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
with n as (select doc_id, length(coalesce(text, '')) as n_chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256 from documents),
w as (select doc_id, text_sha256,
             first_value(doc_id) over (partition by text_sha256 order by n_chars desc, doc_id nulls last rows between unbounded preceding and unbounded following) as keep_id,
             count(*) over (partition by text_sha256) as group_size,
             row_number() over (partition by text_sha256 order by n_chars desc, doc_id nulls last) as r from n)
select doc_id, keep_id, cast(group_size as bigint) as group_size, r = 1 as kept, text_sha256 from w"""
