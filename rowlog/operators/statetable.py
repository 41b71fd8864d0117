"""State of a table kept as it grows: time travel without replaying the log.

The last change of each key by log order, over the changes of a time range, is
a segment; deleted keys stay in it, as a change without data. Segments of
neighbouring ranges fold into one the same way, so the state at an instant is
the fold of a few segments up to it and of the changes after the last one:

    advance(changes, instant)   folds the changes since the last instant (level 0);
                                `FANOUT` segments of a level make one of the next
    at(changes, instant)        covers the time up to `instant` with the largest
                                segments, then reads changes after them only

A segment keeps the order of each key's change, so a change with a later time
but an earlier place in its log doesn't win, as in a full replay. Lower levels
stay for instants in between: with n instants that is n * log(n) at most.

Segments are Parquet under `path`, each visible by the rename of its folder.
Advance to an instant when every log up to it has landed; `unseen` counts
changes that came later with an older time, which call for `rebuild`.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowlog.operators.history import keyed_changes
from rowlog.sinks.manifest import delete, names, new_generation, rename_folder

FANOUT = 4
BEGIN = -(1 << 62)


@dataclass(frozen=True, order=True)
class Segment:
    """The changes with low < time <= high, folded."""

    level: int
    low: int
    high: int

    @property
    def name(self) -> str:
        return f"segment.{self.level}.{self.low}.{self.high}"


class StateTable:
    """The state of one table, whose key columns (and types) are `keys`."""

    def __init__(self, spark: SparkSession, path: str, keys: dict, fanout: int = FANOUT):
        self.spark, self.path, self.keys, self.fanout = spark, path.rstrip("/"), dict(keys), max(2, fanout)

    def segments(self) -> list[Segment]:
        parts = [n.split(".") for n in names(self.spark, self.path) if n.startswith("segment.")]
        return sorted(Segment(*map(int, p[1:])) for p in parts)

    def instant(self) -> int:
        """The instant that the table has been advanced to."""
        return max((s.high for s in self.segments()), default=BEGIN)

    def _fold(self, rows: DataFrame) -> DataFrame:
        """The last change of each key (a struct, so null key fields are keys, too)."""
        return rows.groupBy("key").agg(F.max(F.struct("order", "op", "data")).alias("last"), F.sum("changes").alias("changes")).select(
            "key", "last.*", "changes")

    def _changes(self, changes: DataFrame, low: int, high: int) -> DataFrame:
        some = changes.where((F.col("timestamp") > F.lit(low)) & (F.col("timestamp") <= F.lit(high)))
        k = keyed_changes(some, self.keys)
        data = F.when(F.col("op") != "delete", F.col("data"))
        return k.select(F.struct(*self.keys).alias("key"), F.col("_ord").alias("order"), "op", data.alias("data"),
                        F.col("_ord.sub").cast("long").alias("changes"))  # of a key that moves, one of the two rows

    def _read(self, segment: Segment) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{segment.name}")

    def _write(self, rows: DataFrame, segment: Segment) -> None:
        made = f"{self.path}/_made-{new_generation()}"
        self._fold(rows).write.parquet(made)
        rename_folder(self.spark, made, f"{self.path}/{segment.name}")

    def advance(self, changes: DataFrame, upto_ms: int) -> None:
        """Take in the changes up to `upto_ms`; nothing if that is done already."""
        low = self.instant()
        if upto_ms <= low:
            return
        self._write(self._changes(changes, low, upto_ms), Segment(0, low, upto_ms))
        level = 0
        while True:
            done = max((s.high for s in self.segments() if s.level > level), default=BEGIN)
            rest = [s for s in self.segments() if s.level == level and s.low >= done]
            if len(rest) < self.fanout:
                return
            rows = self._read(rest[0])
            for s in rest[1:]:
                rows = rows.unionByName(self._read(s))
            level += 1
            self._write(rows, Segment(level, rest[0].low, rest[-1].high))

    def cover(self, ts_ms: int) -> list[Segment]:
        """The largest segments that follow each other up to an instant."""
        out, at = [], BEGIN
        while True:
            fits = [s for s in self.segments() if s.low == at and s.high <= ts_ms]
            if not fits:
                return out
            out.append(max(fits, key=lambda s: s.high))
            at = out[-1].high

    def at(self, changes: DataFrame, ts_ms: int) -> DataFrame:
        """The key columns and `data` of the table's rows as of an instant, as `state_at` gives them."""
        cover = self.cover(ts_ms)
        rows = self._changes(changes, cover[-1].high if cover else BEGIN, ts_ms)
        for s in cover:
            rows = rows.unionByName(self._read(s))
        return self._fold(rows).where(F.col("op") != "delete").select("key.*", "data").where(F.col("data").isNotNull())

    def unseen(self, changes: DataFrame) -> int:
        """Changes up to the table's instant that it hasn't taken in."""
        top = self.cover(self.instant())
        known = sum(self._read(s).agg(F.sum("changes")).first()[0] or 0 for s in top)
        return changes.where(F.col("timestamp") <= self.instant()).count() - known

    def rebuild(self, changes: DataFrame) -> None:
        """Fold all changes anew, up to every instant that the table had."""
        instants = [s.high for s in self.segments() if s.level == 0]
        for s in reversed(self.segments()):
            delete(self.spark, f"{self.path}/{s.name}")
        for t in instants:
            self.advance(changes, t)
