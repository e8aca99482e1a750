"""Exact dedup against a persistent digest index (operator 3).

The index is a table bucketed and sorted by digest: one row per distinct
normalised text ever added.  A new batch is reduced to one row per digest
(a map-side-combined aggregate, so a digest holding a third of the rows
sends one row per task), anti-joined with the index by sort-merge join (the
index side reads its buckets without an exchange), and only new digests are
appended.  Rows of the batch then find their keeper by digest.

Texts are equal when identical after deleting every character of
``[\\x20\\x09-\\x0D]``.  Defined results: a null text counts as empty, and all
empty texts are equal; of equal texts the one with the most code points
stays, then the smallest doc_id (null last), then one arbitrary row of fully
repeated ones.  A digest that an earlier batch added keeps its earlier
keeper, so every row of the new batch with it is dropped.  An empty batch
adds nothing.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import materialise
from .common import remove, shared_path, text_of

SPACE = r"[\x20\x09-\x0D]+"


def digest_of(text: Column) -> Column:
    """Lowercase hex SHA-256 of the normalised text in UTF-8."""
    return F.sha2(F.regexp_replace(text, SPACE, "").cast("binary"), 256)


class DigestIndex:
    """A digest index kept as a bucketed, sorted Parquet table."""

    COLUMNS = "digest string, keep_id bigint, keep_rid bigint, group_size bigint, batch string"

    def __init__(self, spark: SparkSession, name: str, path: str | None = None, buckets: int = 64):
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets
        if not spark.catalog.tableExists(name):
            self._save(spark.createDataFrame([], self.COLUMNS), path, "errorifexists")

    def _save(self, rows: DataFrame, path: str | None, mode: str) -> None:
        w = (rows.write.mode(mode).format("parquet")
             .bucketBy(self.buckets, "digest").sortBy("digest"))
        (w.option("path", path) if path else w).saveAsTable(self.name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        if self.path:
            remove(self.spark, self.path)

    def add(self, batch: DataFrame, batch_id: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
        """Append the new digests of ``batch``; return one row per batch row:
        doc_id, keep_id, group_size (rows of this batch with the digest, or
        the keeper's batch if that is larger), kept, text_sha256, is_new.

        Digests already in the index are not appended again, so a job that
        died after its append can be run again under its batch id with the
        same result: a digest that the id added earlier stays new, and its
        keeper is the row with the keeper's doc_id.  Other data under a used
        id only adds its new digests.
        """
        text = text_of(text_col)
        rows = materialise(batch.select(
            F.col(id_col).cast("long").alias("doc_id"),
            digest_of(text).alias("digest"),
            F.length(text).alias("n"),
            F.monotonically_increasing_id().alias("rid")))
        best = F.min(F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("no_id"),
                              "doc_id", "rid")).alias("best")
        found = (rows.groupBy("digest").agg(best, F.count(F.lit(1)).alias("group_size"))
                 .select("digest", F.col("best.doc_id").alias("keep_id"),
                         F.col("best.rid").alias("keep_rid"), "group_size",
                         F.lit(batch_id).alias("batch")))
        new = found.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        self._save(new.repartition(self.buckets, "digest").sortWithinPartitions("digest"),
                   None, "append")
        self.spark.catalog.refreshTable(self.name)
        # The keepers of this batch's digests, written once: the join below
        # then has an exchange on both sides and AQE can split a hot digest.
        # Row numbers of an earlier run mean nothing here, so the keeper's row
        # is found by its doc_id.
        here = found.select("digest", F.col("group_size").alias("here"),
                            F.col("keep_id").alias("best_id"), F.col("keep_rid").alias("rid_here"))
        keepers = materialise(self.rows().drop("keep_rid").join(here, "digest"))
        is_new = F.col("batch") == batch_id
        other = keepers.where(is_new & ~F.col("keep_id").eqNullSafe(F.col("best_id")))
        if not other.isEmpty():  # a used id with other data: its best row is not the keeper
            first = (rows.join(other.select("digest", "keep_id"), "digest")
                     .where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("digest")
                     .agg(F.min(F.struct((-F.col("n")).alias("n"), "rid"))["rid"].alias("rid_first")))
            same = F.col("keep_id").eqNullSafe(F.col("best_id"))
            keepers = materialise(keepers.join(first, "digest", "left").withColumn(
                "rid_here", F.when(same, F.col("rid_here")).otherwise(F.col("rid_first"))))
        return rows.join(keepers.hint("merge"), "digest").select(
            "doc_id", "keep_id", F.greatest("here", "group_size").alias("group_size"),
            (is_new & F.col("rid").eqNullSafe(F.col("rid_here"))).alias("kept"),
            F.col("digest").alias("text_sha256"), is_new.alias("is_new"))


def new_index(spark: SparkSession, buckets: int = 64) -> DigestIndex:
    """An empty index in the session's shared folder."""
    path = shared_path(spark, "digest_index")
    return DigestIndex(spark, path.rsplit("/", 1)[1].replace("-", "_"), path, buckets)


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, batch_id: str | None = None,
                buckets: int = 64) -> DataFrame:
    """``DigestIndex.add`` against ``index``, which needs a batch id, or against a
    new empty one, which goes again: the result reads written rows, not the index."""
    if index is None:
        index = new_index(docs.sparkSession, buckets)
        result = index.add(docs, batch_id or "batch-0")
        index.drop()
        return result
    if batch_id is None:
        raise ValueError("a batch added to an index needs a batch_id")
    return index.add(docs, batch_id)


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    decided = materialise(exact_dedup(docs).select("doc_id", "text_sha256", "kept"))
    keys = decided.where("kept").select(F.col("doc_id").alias("__kept_id"),
                                        F.col("text_sha256").alias("__kept_digest"))
    keyed = docs.withColumn("__digest", digest_of(text_of()))
    same = (F.col("doc_id").eqNullSafe(F.col("__kept_id"))
            & (F.col("__digest") == F.col("__kept_digest")))
    kept = keyed.join(keys, same, "left_semi")
    # Rows repeated with their doc_id and normalised text: the longest stays.
    if not decided.groupBy("doc_id", "text_sha256").count().where("count > 1").isEmpty():
        row = F.struct(*[F.col(c) for c in docs.columns])
        kept = (kept.groupBy(F.col("doc_id").alias("__id"), "__digest")
                .agg(F.max_by(row, F.length(text_of())).alias("__row")).select("__row.*"))
    return kept.select(*docs.columns)
