"""What the operators share: the folder all machines see, staging tables."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The words of every contract: runs of anything but these six characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, a folder of this machine on
    a local master, and an error elsewhere: other machines would not see it."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """df, written to the shared folder and read again: its lineage ends in files
    that survive the loss of executors, and it is computed once."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


def discard(*dfs: DataFrame) -> None:
    """Deletes the files of staged tables that nothing reads any more."""
    for df in dfs:
        spark, path = df.sparkSession, df._tidemark_path
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


#: A key with more than one row in so many is hot.
HOT_SHARE = 1000


def join_hot(rows: DataFrame, lookup: DataFrame, on: str, weight: str, total: int) -> DataFrame:
    """rows left join lookup, which has each key once and in ``weight`` its number of rows of
    ``total``. Rows of hot keys don't meet in one task: at most HOT_SHARE keys can be hot,
    so these are broadcast."""
    hot = F.broadcast(lookup.where(F.col(weight) * HOT_SHARE > total))
    cold = rows.join(hot.select(on), on, "left_anti").join(lookup, on, "left")
    return rows.join(hot, on).unionByName(cold)


#: Parts, by hash, of the rows that share the least count that is kept.
TIE_PARTS = 4096


def most_counted(counts: DataFrame, name: str, most: int) -> list[tuple]:
    """At most ``most`` rows (name, c), the largest c first, among equal ones by name. The
    least c that is taken whole comes from the numbers of rows with each c; of those with
    the next c, parts by a hash of the name are taken as long as they fit. So tasks send
    no more than is kept, and reruns keep the same."""
    upto, least, rest = 0, None, None
    for c, n in counts.groupBy("c").count().orderBy(F.desc("c")).toLocalIterator():
        if upto + n > most:
            rest = c
            break
        upto, least = upto + n, c
    take = F.lit(False) if least is None else F.col("c") >= least
    if rest is not None and upto < most:
        part = F.pmod(F.xxhash64(name), F.lit(TIE_PARTS))
        last = None
        for own, n in counts.where(F.col("c") == rest).groupBy(part.alias("part")).count().orderBy("part").collect():  # at most TIE_PARTS rows
            if upto + n > most:
                break
            upto, last = upto + n, own
        if last is not None:
            take = take | ((F.col("c") == rest) & (part <= last))
    rows = zip(*(x.to_pylist() for x in counts.where(take).select(name, "c").toArrow().columns), strict=True)
    return sorted(rows, key=lambda x: (-x[1], x[0]))


#: Words of 64 bits that a block of a gathered filter holds.
FILTER_BLOCK = 4096


def gather_bits(places: DataFrame, n_bits: int) -> np.ndarray:
    """A filter of n_bits bits, as words of 64, with those set that the one column of
    ``places`` numbers. The driver gets blocks of packed words, 32 KiB each."""
    place = F.col(places.columns[0])
    words = places.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast({places.columns[0]} & 63 as int))")).alias("mask"))

    def pack(rows: pa.Table) -> pa.Table:
        out = np.zeros(FILTER_BLOCK, np.int64)
        out[rows.column("word").to_numpy() % FILTER_BLOCK] = rows.column("mask").to_numpy()
        return pa.table({"block": rows.column("block")[:1], "packed": pa.array([out.tobytes()], pa.binary())})

    blocks = words.withColumn("block", F.floor(F.col("word") / FILTER_BLOCK)).groupBy("block").applyInArrow(pack, "block long, packed binary")
    filled = np.zeros(-(-n_bits // (64 * FILTER_BLOCK)) * FILTER_BLOCK, np.uint64)
    for block, packed in zip(*(c.to_pylist() for c in blocks.toArrow().columns), strict=True):
        filled[block * FILTER_BLOCK : (block + 1) * FILTER_BLOCK] = np.frombuffer(packed, np.uint64)
    return filled


_caches: list[dict] = []


def worker_cache() -> dict:
    """A table that a module keeps in a Python worker from task to task, until ``lean`` empties it."""
    _caches.append({})
    return _caches[-1]


def trim() -> None:
    """Gives back to the system what this process has freed; its allocators would keep it."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back:
        give_back(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, for mapInArrow, in a worker that holds nothing else: workers are used again, and an
    executor's memory would fill with what operators that have ended still keep."""

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cache in _caches:
            cache.clear()
        trim()
        yield from run(batches)
        trim()

    return alone


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str = "text") -> Column:
    """The text as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(column: str = "text") -> Column:
    """Number of words of the whole text; null has none."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD_CLASS)), F.lit(0)).cast("long")


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of the value as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus
