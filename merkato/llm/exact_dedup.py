"""Exact dedup against a persistent digest index.

The index is a table with one row per distinct text, bucketed and sorted by digest. A batch is
reduced to one candidate per digest on the map side first, then removed by a sort-merge anti-join
with the index, whose side needs no exchange, and what is new is appended to the index.

Two texts are equal when they are identical after deleting space and U+0009 to U+000D. Of equal
texts in a batch, the row with the most code points in the original stays, then the smallest id;
a text that an earlier batch has put into the index keeps that batch's row.

Defined cases: a null text is the empty text; empty and blank texts are one group; repeated rows
with one id are members of one group, and where even the ids tie every such row carries the same
answer; a null id comes after all others, so that a group of only null ids has a null ``keep_id`` and no
row marked as kept (``keep_first`` keeps one row of it); an empty batch leaves the index as it is and
gives no rows; a very long text is hashed whole and leaves its row before any exchange; other columns
are not read, and ``keep_first`` carries them along under any name.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merkato.llm.common import store, unused, whole_text, without_blanks
from merkato.session import new_path


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, digest, size)``: SHA-256 of the text without white space, code points of the original."""
    text = whole_text(text_column)
    return docs.select(
        F.col(id_column).alias("id"), F.unhex(F.sha2(without_blanks(text).cast("binary"), 256)).alias("digest"),
        F.char_length(text).cast("long").alias("size"))


class DigestIndex:
    """Digests of all texts admitted so far, in buckets sorted by digest.

    ``location`` outlives the session: opening it again registers the same files under a new table
    name. ``buckets`` must stay what it was when the files were first written.
    """

    COLUMNS = ["digest", "keep_id", "size", "copies"]

    def __init__(self, spark: SparkSession, location: str | None = None, buckets: int = 64):
        self.spark, self.buckets = spark, buckets
        self.location = location or new_path(spark, "digest-index")
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT, size BIGINT, copies BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.location}'")

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def admit(self, rows: DataFrame) -> DataFrame:
        """Append the new digests of ``rows`` (as from ``digests``); returns the index afterwards."""
        best = rows.groupBy("digest").agg(
            F.min_by("id", F.struct(-F.col("size"), F.col("id").isNull(), F.col("id"))).alias("keep_id"), F.max("size").alias("size"),
            F.count("*").alias("copies"))
        new = best.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        # Written apart first: a table can't be appended to while it is being read.
        new = store(new, "new-digests")
        new.repartition(self.buckets, "digest").select(*self.COLUMNS).write.insertInto(self.table)
        return self.rows()


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, id_column: str = "doc_id",
                text_column: str = "text") -> DataFrame:
    """One row per document: ``(doc_id, keep_id, group_size, kept, text_sha256)``.

    ``kept`` is true for the row that stays. A document whose text is in the index from an
    earlier batch gets that batch's ``keep_id`` and is not kept.
    """
    rows = store(digests(docs, id_column, text_column), "digests")
    index = index or DigestIndex(docs.sparkSession)
    known = index.admit(rows)
    # A group of copies may hold a third of all rows: adaptive execution splits its partition.
    return rows.join(known.select("digest", "keep_id", F.col("copies").alias("group_size")), "digest").select(
        F.col("id").alias(id_column), "keep_id", "group_size",
        F.coalesce(F.col("id") == F.col("keep_id"), F.lit(False)).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns; of rows with one id and equal texts, one.

    Ids that several rows have are rare; only those rows are exchanged with their texts.
    """
    found = store(exact_dedup(docs), "exact-dedup")
    ids = found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("rows"), F.max("kept").alias("kept"))
    kept = store(ids.where("kept AND rows = 1").select("doc_id"), "kept-ids")
    repeated, of_id, of_digest, digest_of, chosen = unused(docs, "repeated", "of_id", "of_digest", "digest_of", "chosen")
    again = store(ids.where("rows > 1").select(F.col("doc_id").alias(repeated)), "repeated-ids")
    # The ids grow with the documents, so they are merged at any size and never broadcast.
    single = docs.join(kept.hint("merge"), "doc_id", "left_semi")
    nulls = found.where("doc_id IS NULL").limit(1).count()
    if again.isEmpty() and not nulls:
        return single
    # Rows that share their id, or have none, are told apart by their digest; a kept digest gives one row.
    wanted = found.where("kept OR keep_id IS NULL").select(
        F.col("doc_id").alias(of_id), F.col("text_sha256").alias(of_digest)).distinct()
    shared = docs.join(again, F.col("doc_id") == F.col(repeated), "left_semi").unionByName(docs.where("doc_id IS NULL"))
    digest = F.sha2(without_blanks(whole_text()).cast("binary"), 256)
    longest = shared.withColumn(digest_of, digest).join(
        wanted, F.col("doc_id").eqNullSafe(F.col(of_id)) & (F.col(digest_of) == F.col(of_digest)), "left_semi")
    one = longest.groupBy("doc_id", digest_of).agg(F.max_by(
        F.struct(*docs.columns), F.char_length(whole_text())).alias(chosen))
    return single.unionByName(one.select(f"{chosen}.*"))
