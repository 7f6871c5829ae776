"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions alone.

The documents of a source stand in a shuffled queue (by md5 of id and text) that is
read up to twice. A copy's virtual finish time is its source's cumulative words,
this copy included, divided by the source's target. All copies are range-sorted
globally by that time and truncated at the total budget, so every source has come
equally far when the budget ends: the words of each range are summed, the range in
which the budget ends is summed row by row, and the last copy that fits is the cut.

No sort or window runs over a whole source: queues are cut into slices by the
leading digits of the md5, and slice totals are summed first, so a source with
a third of all rows is spread over as many tasks as there are slices; the sort's
ranges are as many as there are shuffle partitions.

Edge cases: a null text has no words; a null source is a source of its own and
comes last; documents without words are taken 0 words; repeated rows stand side
by side in the queue; ties of the finish time go by source, then by place in the
queue; an empty table, or one without words, takes nothing; other columns are not
looked at. Documents are taken whole, very long ones too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged, table, text_bytes, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_REPEATS = 2
#: Rows that one slice of a queue should hold.
SLICE_ROWS = 20_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """sizes: source, source_size, a row for each source. Adds place, weight, target.

    Sources fill up in the order of cap / weight; one is capped as long as its cap
    is at most its share of what the sources before it leave. That is where
    resharing the excess again and again ends."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    w = sizes.withColumn("place", place)
    w = w.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") - 1) % len(weights) + 1).cast("double"))
    w = w.withColumn("cap", F.col("source_size") * float(MOST_REPEATS))
    whole, before = Window.partitionBy(), Window.orderBy(F.col("cap") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    w = w.withColumns({
        "budget": F.sum("source_size").over(whole) * share, "all_weight": F.sum("weight").over(whole),
        "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0.0)), "weight_before": F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
    })
    level = (F.col("budget") - F.col("cap_before")) / (F.col("all_weight") - F.col("weight_before"))
    w = w.withColumn("capped", F.col("cap") / F.col("weight") <= level)
    gone = lambda c: F.sum(F.when(F.col("capped"), F.col(c)).otherwise(0.0)).over(whole)
    rest = F.try_divide(F.col("budget") - gone("cap"), F.col("all_weight") - gone("weight"))
    return w.select("source", "source_size", "place", "budget", F.when(F.col("capped"), F.col("cap")).otherwise(rest * F.col("weight")).alias("target"))


def _digits(n_rows: int) -> int:
    d = 1
    while n_rows > SLICE_ROWS * 16**d and d < 12:
        d += 1
    return d


def _key(epoch: int) -> Column:
    """The total order of copies: virtual finish time, then source, queue place."""
    end = F.col("source_size") * float(epoch) + F.col("end")
    return F.struct(F.try_divide(end, F.col("target")).alias("finish"), F.col("place"), F.col("h"), F.col("size"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, key: Column | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every row of docs (doc_id, text, source),
    and ``key`` if it is given."""
    more = [] if key is None else ["key"]
    h = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(text_bytes())).cast("binary"))
    rows = staged(docs.select("doc_id", "source", word_count().alias("size"), h.alias("h"), *([] if key is None else [key.alias("key")])), "mix-rows")
    digits = _digits(rows.count())
    rows = rows.withColumn("slice", F.substring("h", 1, digits))
    slices = rows.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    targets = source_targets(slices.groupBy("source").agg(F.sum("slice_size").alias("source_size")), weights, share)
    ahead = Window.partitionBy("place").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.withColumnRenamed("source", "s").join(targets, F.col("s").eqNullSafe(F.col("source"))).withColumn("start", F.coalesce(F.sum("slice_size").over(ahead), F.lit(0))).select(F.col("s").alias("slice_source"), F.col("slice").alias("own_slice"), "place", "source_size", "target", "budget", "start")
    own = Window.partitionBy("source", "slice").orderBy("h", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("inside", F.sum("size").over(own)).join(starts, (F.col("slice") == F.col("own_slice")) & F.col("source").eqNullSafe(F.col("slice_source")))
    placed = staged(placed.select("doc_id", "source", "size", "h", "place", "source_size", "target", "budget", (F.col("start") + F.col("inside")).alias("end"), *more), "mix-queues")
    cut = _cut(in_order(placed))
    taken = F.lit(0).cast("long")
    if cut is not None:
        last = F.struct(F.lit(cut["finish"]).alias("finish"), F.lit(cut["place"]).alias("place"), F.lit(cut["h"]).alias("h"), F.lit(cut["size"]).cast("long").alias("size"))
        for epoch in range(MOST_REPEATS):
            taken = taken + F.when(F.coalesce(_key(epoch) <= last, F.lit(False)), F.col("size")).otherwise(0)
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), *more)


ORDER = ("finish", "place", "h", "size")


def in_order(placed: DataFrame) -> DataFrame:
    """All copies, range-sorted by virtual finish time: part numbers the ranges."""
    copies = placed.select(F.explode(F.array(*map(_key, range(MOST_REPEATS)))).alias("k"), "budget").select("k.*", "budget").where("finish is not null")
    return staged(copies.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).withColumn("part", F.spark_partition_id()), "mix-order")


def _cut(ordered: DataFrame) -> dict | None:
    """The last copy that the budget holds, None if it holds none."""
    last = lambda rows: rows.agg(F.max(F.struct(*ORDER)).alias("k")).first().k
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    # one row for each range of the sort, however many documents
    totals = ordered.groupBy("part").agg(F.sum("size").alias("n"), F.max("budget").alias("budget")).withColumn("upto", F.sum("n").over(upto))
    over = totals.where("upto > budget").orderBy("part").first()
    if over is None:
        best = last(ordered)
        return best and best.asDict()
    inside = Window.partitionBy("part").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    fits = ordered.where(F.col("part") == over.part).withColumn("upto", F.sum("size").over(inside) + (over.upto - over.n)).where(F.col("upto") <= F.col("budget"))
    best = last(fits) or last(ordered.where(F.col("part") < over.part))
    return best and best.asDict()


def op9_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


OP9_SQL = f"""
with r as (select row_number() over () as k, doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size,
                  md5(coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))) as h from documents),
s as (select source, cast(sum(size) as bigint) as source_size from r group by source),
p as (select *, row_number() over (order by source nulls last) as place from s),
w as (select *, cast([5, 2, 1][(place - 1) % 3 + 1] as double) as weight, source_size * 2.0::double as cap from p),
b as (select *, sum(source_size) over () * {SHARE}::double as budget, sum(weight) over () as all_weight,
             coalesce(sum(cap) over o, 0.0) as cap_before, coalesce(sum(weight) over o, 0.0) as weight_before from w
      window o as (order by cap / weight, place rows between unbounded preceding and 1 preceding)),
c as (select *, cap / weight <= (budget - cap_before) / (all_weight - weight_before) as capped from b),
t as (select source, source_size, place, budget,
             case when capped then cap else (budget - sum(case when capped then cap else 0.0 end) over ()) / nullif(all_weight - sum(case when capped then weight else 0.0 end) over (), 0) * weight end as target from c),
q as (select r.*, source_size, place, budget, target, sum(size) over (partition by place order by h, size, k rows unbounded preceding) as "end"
      from r join t on r.source is not distinct from t.source),
v as (select k, size, place, h, budget, (source_size * epoch + "end")::double / nullif(target, 0) as finish from q, (values (0), (1)) as e (epoch)),
g as (select *, sum(size) over (order by finish, place, h, size, k rows unbounded preceding) as upto from v where finish is not null),
l as (select max(struct_pack(finish := finish, place := place, h := h, size := size)) as last from g where upto <= budget),
n as (select k, sum(size) as taken from g, l where struct_pack(finish := finish, place := place, h := h, size := size) <= last group by k)
select doc_id, size, source_size, target, cast(coalesce(taken, 0) as bigint) as taken, source from q left join n using (k)"""
