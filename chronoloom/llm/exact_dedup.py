"""Exact deduplication by keyed streaming state.

The fingerprints of the documents are a stream.  A streaming aggregation keeps,
per digest, the number of documents and the best one so far (most code points,
then smallest id) with its place; the state lies in RocksDB on disk and never
expires, so a later run with the same ``state`` folder continues where the last
one ended.  The state is then read as a table.  Equal digests are only hits: the
normalised bytes of every hit are compared with those of the row that stays, and
groups in which any differ are formed anew on the bytes themselves.

Everything is DataFrame operations.  A digest with a third of all rows is one
state entry fed by partial sums of each task; joins on digests are sort-merge
joins whose skewed partitions Spark splits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chronoloom.llm.common import new_session, scratch_folder, text_or_empty, written

BLANKS = " \t\n\x0b\x0c\r"
#: State on disk.  There is a store for every partition, so each takes little memory and only the disk it needs, and
#: is closed once its batch is committed.
ROCKS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
         "spark.sql.streaming.stateStore.unloadOnCommit": "true",
         "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
         "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
         "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
         "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",
         "spark.sql.streaming.stateStore.rocksdb.blockCacheSizeMB": "4"}


def normalised(column: str = "text") -> Column:
    return F.translate(text_or_empty(column), BLANKS, "")


def sha(norm: Column) -> Column:
    return F.sha2(norm, 256)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 digest: Callable[[Column], Column] = sha, place: Column | None = None) -> DataFrame:
    """Digest, id, code points and place (such as ``input_file_name()``) of every document."""
    norm = normalised(text_col)
    return docs.select(F.col(id_col).cast("long").alias("id"), digest(norm).alias("digest"), sha(norm).alias("sha"),
                       F.length(text_or_empty(text_col)).cast("long").alias("points"), (F.lit("") if place is None else place).alias("place"))


def best() -> Column:
    """Orders candidates of one group: most code points, then smallest id (a missing id counts as the smallest)."""
    return F.max(F.struct(F.col("points"), F.bitwise_not(F.coalesce(F.col("id"), F.lit(-(2**63)))).alias("turned"),
                          F.col("id"), F.col("place"))).alias("best")


def update_state(spark: SparkSession, prints_path: str, schema, state: str, bytes_per_batch: str | None = None) -> DataFrame:
    """Feed new fingerprint files into the state; return (digest, group_size, keep_id, keep_points, keep_place)."""
    own = new_session(spark, **ROCKS)
    reader = own.readStream.schema(schema)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    groups = reader.parquet(prints_path).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), best())
    run = (groups.writeStream.format("noop").outputMode("update").option("checkpointLocation", state)
           .trigger(availableNow=True).start())
    run.awaitTermination()
    kept = spark.read.format("statestore").load(state)
    size, top = [F.col(f"value.`{c}`") for c in kept.schema["value"].dataType.names]
    return kept.select(F.col("key.digest").alias("digest"), size.alias("group_size"), top["id"].alias("keep_id"),
                       top["points"].alias("keep_points"), top["place"].alias("keep_place"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha,
          state: str | None = None, place: Column | None = None) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without blanks; null counts as empty.  The
    row with the most code points stays, then the smallest id.  Rows repeated
    with the same id and text are one group of which every row is reported; all
    of them carry ``kept`` (they cannot be told apart by id; ``unique_rows``
    takes one).  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    prints_path = scratch_folder(spark, "prints")
    plain = fingerprints(docs, id_col, text_col, digest, place)
    plain.write.parquet(prints_path)
    prints = spark.read.schema(plain.schema).parquet(prints_path)
    if prints.isEmpty():
        groups = prints.select("digest", F.lit(0).cast("long").alias("group_size"), F.col("id").alias("keep_id"),
                               F.col("points").alias("keep_points"), F.col("place").alias("keep_place"))
    else:
        groups = written(update_state(spark, prints_path, plain.schema, state or scratch_folder(spark, "state")), "groups")
    out = prints.join(groups, "digest")

    # hits: the bytes of every member of a group against those of the row that stays
    norm = normalised(text_col)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.length(text_or_empty(text_col)).cast("long").alias("points"),
                        norm.alias("norm"), digest(norm).alias("digest"))
    hits = written(texts.join(groups.where("group_size > 1"), "digest"), "hits")
    is_top = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points"))
    top = hits.where(is_top).groupBy("digest").agg(F.min("norm").alias("top_norm"))
    unlike = written(hits.select("digest", "norm").join(top, "digest").where(F.col("norm") != F.col("top_norm"))
                     .select("digest").distinct(), "unlike")
    if not unlike.isEmpty():
        out = out.join(unlike, "digest", "left_anti").unionByName(_by_bytes(hits.join(unlike, "digest", "left_semi")))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size",
                      (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points"))).alias("kept"),
                      F.col("sha").alias("text_sha256"))


def _by_bytes(hits: DataFrame) -> DataFrame:
    """Groups on the normalised text itself, for digests shared by different texts."""
    own = hits.select("digest", "id", "points", "norm", F.lit("").alias("place"))
    groups = own.groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("group_size"), best()).select(
        "digest", "norm", "group_size", F.col("best.id").alias("keep_id"), F.col("best.points").alias("keep_points"),
        F.col("best.place").alias("keep_place"))
    return own.join(groups, ["digest", "norm"]).select("digest", "id", sha(F.col("norm")).alias("sha"), "points", "place",
                                                      "group_size", "keep_id", "keep_points", "keep_place")


def unique_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with their own columns; of rows with the same id and text one stays."""
    kept = written(dedup(docs, id_col, text_col).where("kept").groupBy(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
                   .agg(F.count(F.lit(1)).alias("_rows")), "kept")
    own = docs.withColumn("_own_sha", sha(normalised(text_col)))

    def those(rows: DataFrame) -> DataFrame:
        return own.join(rows, own[id_col].eqNullSafe(rows["_id"]) & (own["_own_sha"] == rows["_sha"]), "left_semi")

    if kept.where("_rows > 1").isEmpty():
        return those(kept).drop("_own_sha")
    again = those(kept.where("_rows > 1")).dropDuplicates([id_col, "_own_sha"])
    return those(kept.where("_rows = 1")).unionByName(again).drop("_own_sha")
