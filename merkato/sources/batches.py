"""Stored tables that are changed by numbered batches, each exactly once.

A batch goes through two steps, each noted in a log beside the table. First the new content of the partitions that
change is written apart in full ("prepared"). Then these partitions are overwritten from that copy ("applied"). A
failure in the first step leaves the table as it was; one in the second, at whatever point, is mended by overwriting from
the same copy again, so that a repeated batch gives the same rows. Batches carry rising numbers. One that was applied is
never applied again, and one that was left prepared is finished before the next is looked at.

While partitions are being replaced, readers may see some of them new and others old.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merkato.session import beside_facts, store

PREPARED, APPLIED = "prepared", "applied"

_LOG = T.StructType([
    T.StructField("batch", T.LongType()), T.StructField("state", T.StringType()), T.StructField("last_key", T.LongType()),
    T.StructField("parts", T.ArrayType(T.IntegerType()))])


class StagedTable:
    """A Parquet table under ``path``; ``partition`` names an integer column beside those of ``schema``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, partition: str | None = None):
        self.spark, self.path, self.schema, self.partition = spark, path.rstrip("/"), schema, partition
        self.stored = T.StructType([*schema.fields, *([T.StructField(partition, T.IntegerType())] if partition else [])])

    def rows(self) -> DataFrame:
        """All rows, with their partition."""
        return self._read(self.path, self.stored)

    def log(self) -> DataFrame:
        """``(batch, state, last_key, parts)``: what was done with each batch, and the partitions it replaced (NULL: the table)."""
        return self._read(f"{self.path}.log", _LOG)

    def has(self, batch: int) -> bool:
        """Whether the batch was applied."""
        return not self.log().where((F.col("batch") == batch) & (F.col("state") == APPLIED)).isEmpty()

    def _read(self, path: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _note(self, batch: int, state: str, last_key: int, parts: list[int] | None) -> None:
        row = self.spark.createDataFrame([(batch, state, last_key, parts)], _LOG)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}.log")

    def _once(self, batch: int, make: Callable[[int], tuple[DataFrame, list[int] | None, int]]) -> bool:
        """Apply a batch unless that was done before. ``make`` takes the last key given so far and returns the new content of
        the partitions that change, these partitions (None for the whole table), and the last key after it."""
        states: dict[int, dict[str, tuple]] = {}
        for row in self.log().collect():  # two rows a batch
            states.setdefault(row.batch, {})[row.state] = (row.last_key, row.parts)
        if APPLIED in states.get(batch, {}):
            return False
        if any(other > batch for other in states):
            raise ValueError(f"batch {batch} comes after batch {max(states)}")
        for other in sorted(states):
            if APPLIED not in states[other] and other != batch:
                self._replace(other, *states[other][PREPARED])
        if batch not in states:
            last_key = max((key for known in states.values() for key, _ in known.values()), default=0)
            content, parts, last_key = make(last_key)
            typed = content.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.stored])
            typed.write.mode("overwrite").parquet(self._copy(batch))
            self._note(batch, PREPARED, last_key, parts)
            states[batch] = {PREPARED: (last_key, parts)}
        self._replace(batch, *states[batch][PREPARED])
        return True

    def _copy(self, batch: int) -> str:
        return f"{self.path}.batches/{batch}"

    def _replace(self, batch: int, last_key: int, parts: list[int] | None) -> None:
        """Overwrite the partitions of a prepared batch from its copy, as often as it takes."""
        if parts is None or parts:
            self._overwrite(self._read(self._copy(batch), self.stored))
        self._note(batch, APPLIED, last_key, parts)

    def _overwrite(self, rows: DataFrame) -> None:
        if self.partition is None:
            rows.write.mode("overwrite").parquet(self.path)
        else:
            rows.hint("rebalance", self.partition).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy(self.partition).parquet(self.path)

    def replace(self, batch: int, make: Callable[[DataFrame], DataFrame]) -> bool:
        """Put ``make(rows so far)`` in the place of the whole table. For small tables."""
        return self._once(batch, lambda last_key: (make(self.rows()), None, last_key))

    def upsert(self, batch: int, rows: DataFrame, keys: list[str]) -> bool:
        """Add rows, or put them in the place of those with equal keys in the same partition; other partitions stay untouched.

        Of rows with equal keys in one batch the greatest is taken.
        """
        def make(last_key: int):
            values = [c for c in self.stored.fieldNames() if c not in keys and c != self.partition]
            typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.stored])
            fresh = store(typed.groupBy(self.partition, *keys).agg(F.max(F.struct(*values)).alias("_row")).select(
                self.partition, *keys, "_row.*"), "fresh-rows")
            # One entry per partition, a month for instance.
            parts = sorted(r[0] for r in fresh.select(self.partition).distinct().collect())
            kept = self.rows().where(F.col(self.partition).isin(parts)).join(beside_facts(fresh), [self.partition, *keys], "left_anti")
            return kept.select(*self.stored.fieldNames()).unionByName(fresh), parts, last_key

        return self._once(batch, make)
