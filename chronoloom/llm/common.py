"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chronoloom.sources.tables import read_table, scratch_folder

#: A word: a run of characters other than space, tab, newline, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"

__all__ = ["WORD", "WordHashes", "held_out", "mix64", "read_table", "run_starts", "scratch_folder", "slices", "text_or_empty", "written"]


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to a new table in the shared folder and read it back: lineage ends here, lost executors lose nothing."""
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def held_out(doc_id: str = "doc_id") -> Column:
    """The fifth of the rows that no model may learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one piece holds about ``limit`` bytes of ``column`` (always whole rows)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
        part = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


class WordHashes(dict):
    """64-bit hash of each word (bytes), remembered for a bounded number of words."""

    def __init__(self, limit: int = 300_000, of: Callable[[bytes], int] = xxhash.xxh3_64_intdigest):
        super().__init__()
        self.limit, self.of = limit, of

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = self.of(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (a multiply and shift finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """Positions at which any of the columns changes (0 included)."""
    n = len(columns[0])
    if not n:
        return np.empty(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def new_session(spark: SparkSession, **conf: str) -> SparkSession:
    """A session of its own for settings that other queries must not see."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    for key, value in conf.items():
        own.conf.set(key.replace("__", "."), value)
    return own


def training_labels(labels: DataFrame, column: str, bound: int) -> DataFrame:
    """(doc_id, y) of at most about ``bound`` labelled rows that may be learned from: all, or a share chosen by hash."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & ~held_out()).groupBy("doc_id").agg(
        F.max(F.col(column).cast("int")).alias("y")).select(F.col("doc_id").cast("long").alias("doc_id"), "y")
    share = min(1.0, bound / max(rows.count(), 1))
    return rows.where(F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
