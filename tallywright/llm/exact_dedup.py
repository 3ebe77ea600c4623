"""Exact duplicates: a persistent digest index, bucketed and sorted, met by sort-merge anti-join.

The index is a table with a row for each text seen: its digest and the document that stands for it. A batch
is reduced to one candidate for each digest (combined before the shuffle), the digests that the index has are
removed by a sort-merge anti-join that reads the index in its own buckets, and the rest is appended.

A batch may come again, as when a job is lost after it appended: the document that stands for a text in the index
stays whenever it is met, so the result is the same and nothing is appended twice.

Defined results: a null text counts as empty; all empty texts are equal. Of rows that repeat a document, text
and id alike, one stays. A null id loses to any id; documents without an id cannot be told apart, and where one stands
for a text in the index, one of a later batch stays too. An empty batch appends nothing. Other columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.llm.common import BLANKS, by_weight, free, same, shared_folder, stored


def normalised(text):
    """The text without white space; missing counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def digested(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, digest (SHA-256 of the normalised text) and points (length of the text as it is)."""
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.unhex(F.sha2(normalised(F.col(text)), 256)).alias("digest"),
        F.length(F.coalesce(F.col(text), F.lit(""))).alias("points"),
    )


class DigestIndex:
    """The texts seen so far, as a table in buckets of the digest, each file sorted by it."""

    def __init__(self, spark: SparkSession, name: str, folder: str, buckets: int):
        """Opens the index stored in ``folder``, or makes an empty one. It keeps the ``buckets`` it was made with."""
        self.spark, self.name, self.buckets = spark, name, buckets
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{name}` (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{folder}'"
        )
        described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED `{name}`").collect()}
        if int(described["Num Buckets"]) != buckets:
            raise ValueError(f"{name} has {described['Num Buckets']} buckets, not {buckets}")

    @classmethod
    def temporary(cls, spark: SparkSession) -> DigestIndex:
        """An empty index for one batch, in the shared folder."""
        name = f"digests_{uuid.uuid4().hex}"
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return cls(spark, name, f"{shared_folder(spark).rstrip('/')}/{name}", buckets)

    def frame(self) -> DataFrame:
        return self.spark.table(f"`{self.name}`")

    def admit(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """Adds the new texts of a batch; a row for each document: digest, keep_id, group_size, kept.

        Of equal texts in the batch the longest original stays, then the smallest id; a text that the index
        already has stays with the document it came from, and no other row is kept for it. ``group_size`` counts the
        rows of this batch.
        """
        # the narrow rows are written once: they are grouped, and joined twice
        batch = stored(
            digested(docs, doc_id, text).withColumn("row", F.monotonically_increasing_id()), "digests-batch"
        )
        best = F.max(F.struct("points", F.bitwise_not("doc_id").alias("first"), F.bitwise_not("row").alias("row")))
        groups = stored(
            batch.groupBy("digest")
            .agg(best.alias("best"), F.count("*").alias("group_size"))
            .select(
                "digest", F.bitwise_not("best.first").alias("doc_id"), F.bitwise_not("best.row").alias("row"), "group_size"
            ),
            "digests-groups",
        )
        fresh = groups.join(self.frame().hint("merge"), "digest", "left_anti")
        fresh = stored(fresh.select("digest", F.col("doc_id").alias("keep_id"), "row"), "digests-fresh")
        known = stored(groups.select("digest").join(self.frame().hint("merge"), "digest").select("digest", "keep_id"), "digests-known")
        (
            fresh.select("digest", "keep_id")
            .repartition(self.buckets, "digest")  # a task for each bucket: one file each
            .write.bucketBy(self.buckets, "digest").sortBy("digest")
            .mode("append").format("parquet").saveAsTable(f"`{self.name}`")
        )
        self.spark.catalog.refreshTable(f"`{self.name}`")
        kept_rows = fresh.select("digest", F.col("row").alias("kept_row"))
        if not known.isEmpty():
            kept_rows = kept_rows.unionByName(self._met_again(batch, known))
        decided = stored(
            groups.select("digest", "group_size")
            .join(self.frame().hint("merge"), "digest")
            .join(kept_rows, "digest", "left"),
            "digests-decided",
        )
        return by_weight(batch, decided, "digest", "group_size", batch.count()).select(
            "doc_id", "keep_id", "group_size",
            F.coalesce(F.col("row") == F.col("kept_row"), F.lit(False)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )

    @staticmethod
    def _met_again(batch: DataFrame, known: DataFrame) -> DataFrame:
        """Of texts the index had before: the row of the very document that stands for each, if the batch has it."""
        known = known.withColumnsRenamed({"digest": "known_digest"})
        # on both columns, so that a text which most rows share is spread by their ids
        own = (F.col("digest") == F.col("known_digest")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
        best = F.max(F.struct("points", F.bitwise_not("row").alias("row")))
        found = batch.join(known, own).groupBy("digest").agg(best.alias("best"))
        return found.select("digest", F.bitwise_not("best.row").alias("kept_row"))


def without_copies(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The documents that stay, with all their columns."""
    kept = (index or DigestIndex.temporary(docs.sparkSession)).admit(docs).where("kept").select("doc_id", "text_sha256")
    (tag,) = free(docs, "sha256")
    tagged = docs.withColumn(tag, F.sha2(normalised(F.col("text")), 256))
    keys = ["doc_id", tag]
    kept = kept.withColumnRenamed("text_sha256", tag)
    # rows that repeat an id and a text meet in the same task; copies of one text under one id are one document
    return tagged.join(kept, same(tagged, kept, keys), "left_semi").dropDuplicates(keys).select(docs.columns)
