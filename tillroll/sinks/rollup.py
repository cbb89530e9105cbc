"""A roll-up that grows slice by slice: stored states, and a ledger of the slices that are in them.

``base-<n>`` holds merged states, sorted by key in files of key ranges, and the ledger of their slices; ``slices`` holds the
states of slices merged since, a folder for each, named by the slice. A slice is merged by publishing its folder, in one
step that only one writer can take; so a slice that comes twice, or from two writers at once, changes nothing the second
time. :meth:`Rollup.compact` makes the next base and takes the folders away that are in it.
"""

from __future__ import annotations

import urllib.parse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.text import utf16_order
from tillroll.operators.aggregate import exact_sum, merge_states
from tillroll.sinks import writers
from tillroll.sources.files import hadoop_path

_STATES = "group_key string, sum_minor bigint, purchase_count bigint"
_LEDGER = "slice string, groups bigint, purchases bigint, sum_minor bigint"


class Rollup:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _names(self, folder: str) -> list[str]:
        jpath, fs = hadoop_path(self.spark, folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(jpath)) if fs.exists(jpath) else []

    def _base(self) -> int:
        """The number of the newest base, 0 if there is none."""
        numbers = (n.removeprefix("base-") for n in self._names(self.path) if n.startswith("base-"))
        return max((int(n) for n in numbers if n.isdigit()), default=0)

    def _folder(self, name: str) -> str:
        return f"{self.path}/slices/{urllib.parse.quote(name, safe='')}"

    def _ledger(self, base: int) -> DataFrame:
        if not base:
            return self.spark.createDataFrame([], _LEDGER)
        return self.spark.read.schema(_LEDGER).parquet(f"{self.path}/base-{base}/ledger")

    def _open_slices(self, base: int) -> list[str]:
        """Folders of slices that are not in the base."""
        quoted = [n for n in self._names(f"{self.path}/slices") if ".tmp-" not in n and not n.endswith(".claim")]
        names = [urllib.parse.unquote(n) for n in quoted]
        if not names or not base:
            return names
        listed = self.spark.createDataFrame([(n,) for n in names], "slice string")
        return sorted(r["slice"] for r in listed.join(self._ledger(base), "slice", "left_anti").collect())

    def slices(self) -> DataFrame:
        """``slice, groups, purchases, sum_minor`` of every slice that is in the roll-up."""
        base = self._base()
        ledger = self._ledger(base)
        if names := self._open_slices(base):
            rows = self.spark.read.schema(_LEDGER).parquet(*(f"{self._folder(n)}/ledger" for n in names))
            ledger = ledger.unionByName(rows)
        return ledger

    def states(self) -> DataFrame:
        """``group_key, sum_minor, purchase_count`` over all slices."""
        base = self._base()
        folders = [f"{self.path}/base-{base}/states"] if base else []
        folders += [f"{self._folder(n)}/states" for n in self._open_slices(base)]
        if not folders:
            return self.spark.createDataFrame([], _STATES)
        return merge_states(self.spark.read.schema(_STATES).parquet(*folders))

    def merge(self, name: str, states: DataFrame) -> bool:
        """Add the states of a slice; False, and no change, if the slice is in the roll-up already.

        A slice that comes again with other totals is refused: it would be neither added nor taken back.
        """
        known = self.slices().where(F.col("slice") == name).first()
        staged = writers.staging_path(self._folder(name))
        try:
            merged = merge_states(states.select("group_key", "sum_minor", "purchase_count"))
            merged.write.mode("errorifexists").parquet(f"{staged}/states")
            written = self.spark.read.schema(_STATES).parquet(f"{staged}/states")
            totals = written.agg(
                F.lit(name).alias("slice"),
                F.count(F.lit(1)).alias("groups"),
                F.coalesce(exact_sum("purchase_count"), F.lit(0)).alias("purchases"),
                F.coalesce(exact_sum("sum_minor"), F.lit(0)).alias("sum_minor"),
            )
            if known is None:
                totals.coalesce(1).write.mode("errorifexists").parquet(f"{staged}/ledger")
                try:
                    writers.publish(self.spark, staged, self._folder(name))
                    return True
                except writers.OutputError:  # another writer has just merged it, or is about to
                    known = self.slices().where(F.col("slice") == name).first()
                    if known is None:
                        raise
            if tuple(known) != tuple(totals.first()):
                raise writers.OutputError(f"Slice {name} is in the roll-up with other states")
            return False
        finally:
            writers.discard(self.spark, staged)

    def compact(self, ranges: int | None = None) -> None:
        """Merge all slices into a new base of key ranges; the base before it stays for those who still read it."""
        base = self._base()
        names = self._open_slices(base)
        if not names:
            return
        target = f"{self.path}/base-{base + 1}"
        staged = writers.staging_path(target)
        order = F.expr(utf16_order("group_key"))
        try:
            states = self.states()
            ranged = states.repartitionByRange(ranges, order) if ranges else states.repartitionByRange(order)
            ranged.sortWithinPartitions(order).write.mode("errorifexists").parquet(f"{staged}/states")
            self.slices().write.mode("errorifexists").parquet(f"{staged}/ledger")
            writers.publish(self.spark, staged, target)
        finally:
            writers.discard(self.spark, staged)
        for name in names:
            writers.discard(self.spark, self._folder(name))
        if base > 1:
            writers.discard(self.spark, f"{self.path}/base-{base - 1}")
