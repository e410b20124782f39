"""Reading tables, CSV files and arrays as series; writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from chronoloom.series import SeriesSpec, to_series


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv_series(spark: SparkSession, path: str, schema: StructType | str, keys, index: str, unit: str,
                    derive: dict | None = None, check: bool = True) -> tuple[DataFrame, SeriesSpec]:
    """CSV with a declared schema, derived columns, then key and index roles."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    if derive:
        df = df.withColumns(derive)
    return to_series(df, keys, index, unit, check=check)


def from_long_ts(df: DataFrame, keys, values: str, start: str, out: str = "value", index: str = "t") -> DataFrame:
    """A regular series stored as (start period, array of values) to rows."""
    return df.select(*keys, F.posexplode(values).alias("_pos", out), F.col(start).alias("_start")).select(
        *keys, (F.col("_start") + F.col("_pos")).cast("long").alias(index), out)


def write_series(df: DataFrame, spec: SeriesSpec, path: str, buckets: int | None = None,
                 fmt: str = "parquet") -> None:
    """Write clustered by key; ``buckets`` hash folders allow pruned reads.

    Rows of one key are spread over blocks of time, so a hot key does not make
    one huge file.
    """
    from chronoloom.operators.blocks import BLOCK
    if spec.keys:
        out = df.repartition(*spec.by, F.floor(F.col(spec.t) / BLOCK))
    else:
        out = df.repartition(F.floor(F.col(spec.t) / BLOCK))
    out = out.sortWithinPartitions(*spec.by, spec.t)
    if buckets and spec.keys:
        out = out.withColumn("key_bucket", F.pmod(F.hash(*spec.by), F.lit(buckets)))
        out.write.mode("overwrite").partitionBy("key_bucket").format(fmt).save(path)
    else:
        out.write.mode("overwrite").format(fmt).save(path)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one named by spark.checkpoint.dir."""
    import tempfile
    import uuid
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="chronoloom-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
