"""The series used by the queries, derived from the given tables.

Money is summed as whole cents, which makes the totals independent of the
order of addition, then scaled to millions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chronoloom.functions.calendar import truncate
from chronoloom.operators.index import fill_gaps, index_by
from chronoloom.series import SeriesSpec, to_series
from chronoloom.sources.tables import read_table


def cents(col: str) -> Column:
    return F.round(F.col(col) * 100).cast("long")


def millions(col: str) -> Column:
    return F.sum(cents(col)) / 1e8


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def raw_orders_monthly(spark: SparkSession, d: str) -> tuple[DataFrame, SeriesSpec]:
    o = read_table(spark, d, "orders").select(F.col("o_orderpriority").alias("priority"), "o_orderdate", "o_totalprice")
    m = index_by(o, ["priority"], "o_orderdate", "month", [millions("o_totalprice").alias("y")], "month")
    return to_series(m, ["priority"], "month", "month", check=False)


def orders_monthly(spark: SparkSession, d: str) -> tuple[DataFrame, SeriesSpec]:
    """Order value per priority and month, in millions; empty months are 0."""
    df, spec = raw_orders_monthly(spark, d)
    return fill_gaps(df, spec, {"y": 0.0})


OM_RAW = """omr AS (
  SELECT o_orderpriority AS priority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS BIGINT) AS t,
         CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) / 1e8 AS y
  FROM orders GROUP BY ALL)"""
OM = OM_RAW + """,
omc AS (SELECT priority, unnest(range(min(t), max(t) + 1)) AS t FROM omr GROUP BY priority),
om AS (SELECT omc.priority, omc.t, make_date(omc.t // 12, omc.t % 12 + 1, 1) AS month, coalesce(y, 0.0) AS y
       FROM omc LEFT JOIN omr USING (priority, t))"""


def ship_daily_raw(spark: SparkSession, d: str) -> tuple[DataFrame, SeriesSpec]:
    li = read_table(spark, d, "lineitem").select(F.col("l_returnflag").alias("flag"), "l_shipdate", "l_quantity")
    s = index_by(li, ["flag"], "l_shipdate", "day",
                 [F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("qty")], "day")
    return to_series(s, ["flag"], "day", "day", check=False)


def ship_daily(spark: SparkSession, d: str) -> tuple[DataFrame, SeriesSpec]:
    """Shipments and hundreds of units per return flag and day, gaps as 0."""
    df, spec = ship_daily_raw(spark, d)
    df, spec = fill_gaps(df, spec, {"n": 0, "qty": 0})
    return df.withColumn("y", F.col("qty") / 1e2), spec


SD_RAW = """sdr AS (
  SELECT l_returnflag AS flag, CAST(l_shipdate AS DATE) AS day,
         CAST(CAST(l_shipdate AS DATE) - DATE '1970-01-01' AS BIGINT) AS t,
         count(*) AS n, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty
  FROM lineitem GROUP BY ALL)"""
SD = SD_RAW + """,
sdc AS (SELECT flag, unnest(range(min(t), max(t) + 1)) AS t FROM sdr GROUP BY flag),
sd AS (SELECT sdc.flag, sdc.t, CAST(DATE '1970-01-01' + CAST(sdc.t AS INTEGER) AS DATE) AS day, coalesce(n, 0) AS n,
              coalesce(qty, 0) AS qty, coalesce(qty, 0) / 1e2 AS y
       FROM sdc LEFT JOIN sdr USING (flag, t))"""


def events_hourly_raw(spark: SparkSession, d: str) -> tuple[DataFrame, SeriesSpec]:
    e = read_table(spark, d, "events").select("event_type", "ts", "value")
    h = index_by(e, ["event_type"], "ts", "hour",
                 [F.count("*").alias("n"), (F.sum(cents("value")) / 1e2 / F.count("value")).alias("y")], "hour")
    return to_series(h, ["event_type"], "hour", "hour", check=False)


def events_hourly(spark: SparkSession, d: str) -> tuple[DataFrame, SeriesSpec]:
    """Events per type and hour; the mean value of an empty hour is NULL."""
    df, spec = events_hourly_raw(spark, d)
    return fill_gaps(df, spec, {"n": 0})


EH_RAW = """ehr AS (
  SELECT event_type, date_trunc('hour', ts) AS hour,
         CAST(CAST(ts AS DATE) - DATE '1970-01-01' AS BIGINT) * 24 + hour(ts) AS t,
         count(*) AS n, CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS BIGINT) / 1e2 / count(value) AS y
  FROM events GROUP BY ALL)"""
EH = EH_RAW + """,
ehc AS (SELECT event_type, unnest(range(min(t), max(t) + 1)) AS t FROM ehr GROUP BY event_type),
eh AS (SELECT ehc.event_type, ehc.t, TIMESTAMP '1970-01-01' + INTERVAL 1 HOUR * ehc.t AS hour,
              coalesce(n, 0) AS n, y FROM ehc LEFT JOIN ehr USING (event_type, t))"""


def user_daily(spark: SparkSession, d: str) -> tuple[DataFrame, SeriesSpec]:
    """Events per user, type and day: intermittent counts, gaps as 0."""
    e = read_table(spark, d, "events").select("user_id", "event_type", "ts")
    u = index_by(e, ["user_id", "event_type"], "ts", "day", [F.count("*").cast("double").alias("y")], "day")
    df, spec = to_series(u, ["user_id", "event_type"], "day", "day", check=False)
    return fill_gaps(df, spec, {"y": 0.0})


UD = """udr AS (
  SELECT user_id, event_type, CAST(CAST(ts AS DATE) - DATE '1970-01-01' AS BIGINT) AS t, CAST(count(*) AS DOUBLE) AS y
  FROM events GROUP BY ALL),
udc AS (SELECT user_id, event_type, unnest(range(min(t), max(t) + 1)) AS t FROM udr GROUP BY user_id, event_type),
ud AS (SELECT udc.*, coalesce(y, 0.0) AS y FROM udc LEFT JOIN udr USING (user_id, event_type, t))"""


def part_attrs(spark: SparkSession, d: str) -> tuple[DataFrame, SeriesSpec]:
    """Several measures per brand and quarter of shipment."""
    li = read_table(spark, d, "lineitem").select("l_partkey", "l_shipdate", "l_quantity", "l_extendedprice",
                                                 "l_discount", "l_tax")
    # reduce to (part, quarter) before the join, so the join sees far fewer rows
    pre = li.groupBy("l_partkey", truncate(F.col("l_shipdate"), "quarter").alias("quarter")).agg(
        F.sum(F.col("l_quantity").cast("long")).alias("q"), F.sum(cents("l_extendedprice")).alias("p"),
        F.sum(cents("l_discount")).alias("dc"), F.sum(cents("l_tax")).alias("tx"), F.count("*").alias("c"))
    part = read_table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand"))
    out = pre.join(part, "l_partkey").groupBy("brand", "quarter").agg(
        (F.sum("q") / 1e3).alias("qty"), (F.sum("p") / 1e8).alias("price"),
        (F.sum("dc") / 1e2 / F.sum("c")).alias("discount"), (F.sum("tx") / 1e2 / F.sum("c")).alias("tax"),
        F.sum("c").alias("n"))
    return to_series(out, ["brand"], "quarter", "quarter", check=False)


PA = """pa AS (
  SELECT p_brand AS brand, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS quarter,
         CAST(year(l_shipdate) * 4 + quarter(l_shipdate) - 1 AS BIGINT) AS t,
         CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) / 1e3 AS qty,
         CAST(SUM(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) / 1e8 AS price,
         CAST(SUM(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) / 1e2 / count(*) AS discount,
         CAST(SUM(CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT) / 1e2 / count(*) AS tax, count(*) AS n
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)"""


def trade_leaves(spark: SparkSession, d: str) -> tuple[DataFrame, SeriesSpec]:
    """Order value per region, nation and segment: leaves of the hierarchies."""
    o = read_table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    pre = o.groupBy("o_custkey", truncate(F.col("o_orderdate"), "month").alias("month")).agg(
        F.sum(cents("o_totalprice")).alias("c"))
    cust = read_table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey",
                                                   F.col("c_mktsegment").alias("segment"))
    geo = (read_table(spark, d, "nation").join(read_table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
           .select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("region"), F.col("n_name").alias("nation")))
    out = (pre.join(cust, "o_custkey").join(geo, "c_nationkey")
              .groupBy("region", "nation", "segment", "month").agg((F.sum("c") / 1e8).alias("y")))
    return to_series(out, ["region", "nation", "segment"], "month", "month", check=False)


TL = """tl AS (
  SELECT r_name AS region, n_name AS nation, c_mktsegment AS segment, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS BIGINT) AS t,
         CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) / 1e8 AS y
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)"""

LAST_DAY = "2000-08-01"  # split of the monthly series: training ends before this day


def split(df: DataFrame, index: str = "month", day: str = LAST_DAY) -> tuple[DataFrame, DataFrame]:
    cut = F.lit(day).cast("date")
    return df.where(F.col(index) < cut), df.where(F.col(index) >= cut)
