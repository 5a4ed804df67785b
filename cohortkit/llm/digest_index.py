"""Exact deduplication against a persistent digest index (DataFrame functions only)."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortkit.llm.common import ascii_lower, first_row, rows_of
from cohortkit.operators.sizing import small_side
from cohortkit.session import materialize

DIGEST = "text_sha256"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_sha256): digest of the whole text, A-Z lower-cased, NULL as empty."""
    rows = rows_of(docs, doc_id=id_col, text=text_col)
    return rows.select("doc_id", F.sha2(ascii_lower(F.coalesce("text", F.lit(""))).cast("binary"), 256).alias(DIGEST))


class DigestIndex:
    """One row per distinct text ever added, bucketed and sorted by digest.

    The table lives at ``path`` and outlives the session: opening it again registers it
    anew. ``buckets`` is fixed when it is created (default: the shuffle partitions of
    then); take about one per 200 MB of digests expected.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path
        self.buckets = int(buckets or spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = "digest_index_" + hashlib.sha256(path.encode()).hexdigest()[:24]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({DIGEST} STRING, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY ({DIGEST}) SORTED BY ({DIGEST}) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )

    def table(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Deduplicate a batch against the index and itself, and append what is new.

        Returns one row per input row: doc_id, keep_id, group_size (equal rows of this
        batch), kept, text_sha256. Of equal texts in a batch the largest id stays; a text
        that an earlier batch added keeps the earlier id, and its rows of this batch go.
        Adding a batch twice gives the same answer, so a job that died after the append
        can be run again. Two rows with the same id and text are both marked as kept.
        NULL texts equal the empty text; a NULL id stays only in a group whose ids are all
        NULL, where keep_id is NULL; an empty batch gives no rows.

        Groups are merged before the shuffle (one row per text and task). The anti-join
        reads the index by bucket, without moving it; rows meet their decision in a join
        of two shuffled sides, which adaptive execution splits at a hot digest.
        """
        rows = materialize(digests(docs, id_col, text_col))
        groups = materialize(rows.groupBy(DIGEST).agg(F.max("doc_id").alias("newest"), F.count(F.lit(1)).alias("group_size")))
        fresh = groups.join(self.table().hint("merge"), DIGEST, "left_anti")
        fresh.select(DIGEST, F.col("newest").alias("keep_id")).write.insertInto(self.name)
        decided = materialize(groups.join(self.table().hint("merge"), DIGEST).select(DIGEST, "keep_id", "group_size"))
        return rows.join(decided, DIGEST).select(
            "doc_id", "keep_id", "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), DIGEST,
        )

    def drop(self) -> None:
        """Forget the table and delete its files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def add_from_largest(self, docs: DataFrame, batches: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """The rows of :meth:`add` for a whole table that is added batch by batch, the largest ids first.

        Of equal texts the earlier batch stays, so over all batches the row with the
        largest id does, as if the table were one batch; group_size counts all equal rows.
        Batches are ranges of ids of equal width; rows with a NULL id come with the last.
        """
        ids = docs.agg(F.min(f"`{id_col}`").alias("low"), F.max(f"`{id_col}`").alias("high")).first()
        own, found = F.col(f"`{id_col}`"), []
        low, high = ids["low"] or 0, ids["high"] or 0
        edges = [low + (high + 1 - low) * i // batches for i in range(batches + 1)]
        for i in reversed(range(batches)):
            inside = (own >= edges[i]) & (own < edges[i + 1])
            batch = docs.where(F.coalesce(inside, F.lit(i == 0)))
            found.append(materialize(self.add(batch, id_col, text_col)).drop("group_size"))
        rows = reduce(DataFrame.unionByName, found)
        sizes = rows.groupBy(DIGEST).agg(F.count(F.lit(1)).alias("group_size"))
        return rows.join(materialize(sizes), DIGEST).select("doc_id", "keep_id", "group_size", "kept", DIGEST)

    def deduplicate(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """The rows of a batch, with all their columns, that ``add`` keeps; of several kept
        rows with one digest and id (or none) one stays, the first by its JSON form.

        Rows that go are matched by digest and id: in a broadcast if they were counted to
        be few, else in a join that a large group of copies cannot skew. Rows that share
        an id are reduced to one in each task before they move.
        """
        found = self.add(docs, id_col, text_col)
        gone = materialize(found.where("NOT kept").select("doc_id", DIGEST))
        again = materialize(found.where("kept AND group_size > 1").groupBy("doc_id", DIGEST).count()
                            .where("count > 1").select("doc_id", DIGEST))
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
        text = F.col(f"`{text_col}`")
        digest = F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256)
        held = docs.select(row, F.col(f"`{id_col}`").alias("own_id"), digest.alias("own_digest"))
        same = (F.col("own_digest") == F.col(DIGEST)) & F.col("own_id").eqNullSafe(F.col("doc_id"))
        stay = held.join(small_side(gone), same, "left_anti")
        if again.isEmpty():
            return stay.select("row.*")
        again = small_side(again)
        one = stay.join(again, same, "left_semi").groupBy("own_digest", "own_id").agg(first_row("row").alias("row"))
        return stay.join(again, same, "left_anti").select("row.*").unionByName(one.select("row.*"))
