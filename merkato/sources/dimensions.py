"""A versioned dimension kept in files and changed batch by batch.

Versions are partitioned by the month in which they were closed (``ClosedMonth``, YYYYMM); active ones are in
partition 0. A batch of changes from some instant on can only alter versions that are active or were closed
in that month or later, so only those partitions are read, and of them only those in which something changes are replaced.

A version's end is the start of the next one, and starts are never taken away; so no partition that a batch touches becomes
empty. Batches are applied exactly once, as ``StagedTable`` describes; new surrogate keys follow the last one in its log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merkato.operators.loading import changed_versions, dated_changes
from merkato.session import beside_facts, store
from merkato.sources.batches import StagedTable

VALIDITY = ["ValidFrom", "ValidTo", "IsActive"]
PARTITION = "ClosedMonth"


def closed_month() -> Column:
    return F.when(F.col("IsActive"), 0).otherwise(F.year("ValidTo") * 100 + F.month("ValidTo")).cast("int")


class VersionedDimension(StagedTable):
    """``schema`` is that of the dimension: surrogate key, natural key, tracked columns, validity."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, natural_key: list[str], surrogate_key: str):
        super().__init__(spark, path, schema, PARTITION)
        self.natural_key, self.surrogate_key = natural_key, surrogate_key
        self.tracked = [c for c in schema.fieldNames() if c not in (surrogate_key, *natural_key, *VALIDITY)]

    def current(self) -> DataFrame:
        return self.rows().where(F.col(PARTITION) == 0).drop(PARTITION)

    def apply(self, batch: int, incoming: DataFrame, effective: str = "effective") -> bool:
        """Apply dated changes once; false where this batch was applied before.

        ``incoming`` holds the natural key, the tracked columns and the instant from which they hold, as for
        ``scd2_merge``, whose rules are followed. Rows without key or instant are left out.
        """
        return self._once(batch, lambda last_key: self._changed(incoming, effective, last_key))

    def _changed(self, incoming: DataFrame, effective: str, last_key: int) -> tuple[DataFrame, list[int], int]:
        changes = dated_changes(incoming, self.natural_key, self.tracked, effective)
        first = changes.agg(F.min("ValidFrom")).first()[0]
        keys = beside_facts(changes.select(*self.natural_key).distinct(), changes)
        reached = F.col(PARTITION) == 0
        if first is not None:
            reached = reached | (F.col(PARTITION) >= first.year * 100 + first.month)
        before = self.rows().where(reached)
        own = store(before.join(keys, self.natural_key, "left_semi"), "own-versions")
        after = store(changed_versions(
            own, changes, self.natural_key, self.tracked, self.surrogate_key, last_key + 1).select(
            *[F.col(f.name).cast(f.dataType) for f in self.schema.fields], closed_month().alias(PARTITION)), "new-versions")

        # Partitions in which a version is new, ends elsewhere or holds other values. One entry per month.
        columns = self.stored.fieldNames()
        was = own.select(F.col(self.surrogate_key).alias("_key"), F.col(PARTITION).alias("_month"), F.struct(*columns).alias("_was"))
        moved = after.join(beside_facts(was, own), F.col(self.surrogate_key) == F.col("_key"), "left").where(
            ~F.struct(*columns).eqNullSafe(F.col("_was")))
        months = sorted(r[0] for r in moved.select(F.explode(F.array_compact(F.array(PARTITION, "_month")))).distinct().collect())

        touched = F.col(PARTITION).isin(months)
        others = before.where(touched).join(keys, self.natural_key, "left_anti").select(*columns)
        last_key = max(last_key, after.agg(F.max(self.surrogate_key)).first()[0] or 0)
        return others.unionByName(after.where(touched)), months, last_key
