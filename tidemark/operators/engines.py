"""Table semantics: how changes become rows of an append-only log, and how the
current state is read from it.

Changes have commit_lsn, seq, op and the columns old_<c> and new_<c>; truncates
are not among them but in a table of their own (commit_lsn, seq). No row of a
log is ever rewritten, so a log can be written in any batches.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.changes import all_same


@dataclass(frozen=True)
class Engine:
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    compat: bool = False
    extra: tuple[str, ...] = field(default=())

    def image(self, side: str, sub: int, **marks: Column) -> Column:
        cols = [F.col(f"{side}_{c}").alias(c) for c in self.columns] + [F.col(c) for c in self.extra]
        return F.struct(*cols, *(v.alias(k) for k, v in marks.items()), F.lit(sub).alias("sub"))

    def rows(self, changes: DataFrame, images: Column) -> DataFrame:
        exploded = changes.select("commit_lsn", "seq", F.explode(images).alias("r"))
        return exploded.select("r.*", "commit_lsn", "seq")

    def noop(self) -> Column:
        return all_same([(f"old_{c}", f"new_{c}") for c in self.columns], self.compat)

    def key_changed(self) -> Column:
        return ~all_same([(f"old_{c}", f"new_{c}") for c in self.keys], self.compat)


class AppendEngine(Engine):
    """Inserts alone."""

    def rewrite(self, changes: DataFrame) -> DataFrame:
        return self.rows(changes.where("op = 'I'"), F.array(self.image("new", 0)))

    def current(self, log: DataFrame) -> DataFrame:
        return log.select(*self.columns)


class ReplacingEngine(Engine):
    """The latest version of a key wins, unless it is marked deleted. compat marks
    deletions with 0, as the replicated design does."""

    def rewrite(self, changes: DataFrame) -> DataFrame:
        ver = F.col("commit_lsn")
        mark = lambda n: F.lit(n).cast("smallint")
        new = self.image("new", 1, ver=ver, is_deleted=mark(0))
        gone = lambda n: self.image("old", 0, ver=ver, is_deleted=mark(n))
        images = (
            F.when(F.col("op") == "I", F.array(new))
            .when(F.col("op") == "D", F.array(gone(0 if self.compat else 1)))
            .when((F.col("op") == "U") & ~self.noop(), F.when(self.key_changed(), F.array(gone(1), new)).otherwise(F.array(new)))
        )
        return self.rows(changes, images)

    def current(self, log: DataFrame, by: str = "ver") -> DataFrame:
        """An aggregate, not a sort: partial results are combined before the shuffle."""
        rest = [c for c in (*self.columns, *self.extra) if c not in self.keys]
        best = F.max_by(F.struct(*rest, "is_deleted"), F.struct(by, "seq", "sub")).alias("best")
        return log.groupBy(*self.keys).agg(best).where("best.is_deleted = 0").select(*(F.col(c) if c in self.keys else F.col(f"best.{c}") for c in self.columns))


class CollapsingEngine(Engine):
    """Old images cancel equal new images by sign."""

    def rewrite(self, changes: DataFrame) -> DataFrame:
        sign = lambda n: F.lit(n).cast("tinyint")
        old, new = self.image("old", 0, sign=sign(-1)), self.image("new", 1, sign=sign(1))
        images = F.when(F.col("op") == "I", F.array(new)).when(F.col("op") == "D", F.array(old)).when((F.col("op") == "U") & ~self.noop(), F.array(old, new))
        return self.rows(changes, images)

    def current(self, log: DataFrame) -> DataFrame:
        """Every distinct row as often as its signs sum to; a negative sum means that the log is incomplete."""
        sums = log.groupBy(*self.columns).agg(F.sum("sign").alias("n")).where("n <> 0")
        times = F.when(F.col("n") > 0, F.col("n")).otherwise(F.raise_error(F.lit("more deletions than insertions: the log is incomplete")).cast("bigint"))
        return sums.select(*self.columns, F.explode(F.sequence(F.lit(1).cast("bigint"), times)).alias("__i")).drop("__i")


def check_sum(log: DataFrame, value: str) -> DataFrame:
    """The sum and the count of the source, from the signed log."""
    return log.agg(F.sum(F.col(value) * F.col("sign")).alias("value_sum"), F.sum("sign").alias("n_rows"))


def after_truncates(log: DataFrame, truncates: DataFrame) -> DataFrame:
    """Rows beyond the last truncate; the scalar is one row."""
    last = truncates.agg(F.max(F.struct("commit_lsn", "seq")).alias("last"))
    return log.crossJoin(F.broadcast(last)).where("last is null or struct(commit_lsn, seq) > last").drop("last")


def snapshot_and_stream(snapshot: DataFrame, stream: DataFrame, snapshot_lsn: int) -> DataFrame:
    """Disjoint by position: the stream's rows count beyond the snapshot's."""
    return snapshot.unionByName(stream.where(F.col("commit_lsn") > snapshot_lsn))


def compact(engine: ReplacingEngine | CollapsingEngine, log: DataFrame) -> DataFrame:
    """The log with what its own rows make obsolete left out; its current state is the same.
    Rows before a truncate have to be gone already (after_truncates): what it removed must
    not cancel what came later. A row that is left keeps its last position, so truncates
    that come after it still find it."""
    if isinstance(engine, ReplacingEngine):
        rest = [c for c in log.columns if c not in engine.keys]
        best = F.max_by(F.struct(*rest), F.struct("ver" if "ver" in rest else engine.extra[0], "seq", "sub")).alias("best")
        return log.groupBy(*engine.keys).agg(best).select(*(F.col(c) if c in engine.keys else F.col(f"best.{c}") for c in log.columns))
    sums = log.groupBy(*engine.columns).agg(F.sum("sign").alias("n"), F.max(F.struct("commit_lsn", "seq")).alias("at"))
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("n"))).alias("__i")
    return sums.where("n <> 0").select(*engine.columns, F.signum("n").cast("tinyint").alias("sign"), "at.commit_lsn", "at.seq", F.lit(1).alias("sub"), copies).drop("__i")
