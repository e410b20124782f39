"""Sources, projection, filtering, reshaping, joins and plain aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.operators import reshape as rs
from chronoloom.operators.index import filter_index, head, tail
from chronoloom.operators.quantile import group_quantiles, iqr_outliers
from chronoloom.plans.base import (
    EH, OM, PA, SD, TL, events_hourly, orders_monthly, part_attrs, ship_daily, trade_leaves, with_ctes)
from chronoloom.plans.catalog import query
from chronoloom.series import update_index
from chronoloom.sources.tables import from_long_ts, read_csv_series, read_table, scratch_folder, write_series


# ---- sources and sinks -------------------------------------------------

@query("read_table", "SELECT l_returnflag, l_shipdate, l_quantity FROM lineitem")
def read_table_(spark, d):
    return read_table(spark, d, "lineitem").select("l_returnflag", "l_shipdate", "l_quantity")


@query("read_csv_series", with_ctes(OM, body="""SELECT priority, CAST(date_trunc('quarter', month) AS DATE) AS quarter,
  CAST(year(month) * 4 + quarter(month) - 1 AS BIGINT) AS t, sum(y) AS y FROM om GROUP BY ALL"""))
def read_csv(spark, d):
    df, _ = orders_monthly(spark, d)
    quarterly = df.groupBy("priority", F.trunc("month", "quarter").alias("date")).agg(F.sum("y").alias("y"))
    path = scratch_folder(spark, "csv")
    quarterly.write.option("header", True).csv(path)
    out, _ = read_csv_series(spark, path, "priority string, date date, y double", ["priority"], "quarter", "quarter",
                             derive={"quarter": F.trunc("date", "quarter")})
    return out.select("priority", "quarter", "t", "y")


@query("from_long_ts", with_ctes(OM, body="SELECT priority, t, y AS value FROM om"))
def from_long(spark, d):
    df, spec = orders_monthly(spark, d)
    from chronoloom.operators.blocks import block_arrays
    base = block_arrays(df, spec.by, "t", ["y"])
    base = base.select("priority", F.col("pts")[0]["t"].alias("start"), F.col("pts.y").alias("values"))
    return from_long_ts(base, ["priority"], "values", "start")


@query("sink", with_ctes(OM, body="SELECT priority, month, t, y FROM om"))
def sink(spark, d):
    df, spec = orders_monthly(spark, d)
    path = scratch_folder(spark, "series")
    write_series(df, spec, path, buckets=4)
    return spark.read.parquet(path).select("priority", "month", "t", "y")


@query("to_plain_table", with_ctes(OM, body="SELECT priority, sum(y) AS y FROM om GROUP BY priority"))
def to_plain_table(spark, d):
    df, _spec = orders_monthly(spark, d)  # dropping the spec is all it takes
    return df.groupBy("priority").agg(F.sum("y").alias("y"))


@query("as_series", with_ctes(OM, body="SELECT priority, CAST(date_trunc('year', month) AS DATE) AS year, CAST(year(month) AS BIGINT) AS t, sum(y) AS y FROM om GROUP BY ALL"))
def as_series(spark, d):
    df, spec = orders_monthly(spark, d)
    yearly = df.groupBy("priority", F.trunc("month", "year").alias("year")).agg(F.sum("y").alias("y"))
    out, _ = update_index(yearly, spec, index="year", unit="year", regular=True)
    return out.select("priority", "year", "t", "y")


# ---- projection and filter ---------------------------------------------

@query("filter", """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' AND year(o_orderdate) >= 1998
  AND NOT (o_orderstatus = 'P') AND o_orderstatus IN ('F', 'O')""")
def filter_(spark, d):
    o = read_table(spark, d, "orders")
    return o.where((F.col("o_orderpriority") == "1-URGENT") & (F.year("o_orderdate") >= 1998)
                   & ~(F.col("o_orderstatus") == "P") & F.col("o_orderstatus").isin("F", "O")
                   ).select("o_orderkey", "o_totalprice")


@query("filter_group_extreme", with_ctes(SD, body="""SELECT flag, day, n FROM (SELECT *, max(day) OVER (PARTITION BY flag, year(day)) AS last FROM sd) WHERE day = last"""))
def filter_group_extreme(spark, d):
    df, _ = ship_daily(spark, d)
    return rs.filter_group_extreme(df, ["flag"], F.year("day"), "day").select("flag", "day", "n")


@query("filter_outlier_iqr", with_ctes(EH, body="""SELECT event_type, hour, y FROM eh JOIN (
  SELECT event_type, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.75) AS q3 FROM eh GROUP BY 1) USING (event_type)
  WHERE y < q1 - 3 * (q3 - q1) OR y > q3 + 3 * (q3 - q1)"""))
def filter_outlier_iqr(spark, d):
    df, spec = events_hourly(spark, d)
    return iqr_outliers(df, spec.by, "y").select("event_type", "hour", "y")


@query("filter_index", """SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= '1996-04-01' AND o_orderdate < '2000-01-01'
  UNION ALL SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= '2001-02-01'""")
def filter_index_(spark, d):
    o = read_table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return filter_index(o, "o_orderdate", "1996 Q2", "1999 Q4").unionAll(filter_index(o, "o_orderdate", "2001 Feb"))


@query("mutate", with_ctes(PA, body="SELECT brand, quarter, price / qty AS price_per_unit, ln(price) AS log_price, n / qty AS lines_per_unit FROM pa"))
def mutate(spark, d):
    df, _ = part_attrs(spark, d)
    return df.select("brand", "quarter", (F.col("price") / F.col("qty")).alias("price_per_unit"),
                     F.log("price").alias("log_price"), (F.col("n") / F.col("qty")).alias("lines_per_unit"))


@query("select", "SELECT o_totalprice AS price, o_orderkey, o_orderpriority, o_orderdate FROM orders")
def select_(spark, d):
    o = read_table(spark, d, "orders").drop("o_custkey")
    named = rs.select_matching(o, "order", always=["o_totalprice"]).drop("o_orderstatus")
    return rs.relocate(named.withColumnRenamed("o_totalprice", "price"), "o_orderdate")


@query("select_range", "SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def select_range(spark, d):
    return rs.select_range(read_table(spark, d, "lineitem"), "l_quantity", "l_tax")


@query("recode", "SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'AUTO' WHEN 'MACHINERY' THEN 'MACH' ELSE c_mktsegment END AS segment FROM customer")
def recode(spark, d):
    c = read_table(spark, d, "customer")
    return c.select("c_custkey", rs.recode(F.col("c_mktsegment"), {"AUTOMOBILE": "AUTO", "MACHINERY": "MACH"}).alias("segment"))


@query("case_when", """SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'Purchase' WHEN isodow(ts) <= 5 THEN 'Weekday' ELSE 'Weekend' END AS day_type FROM events""")
def case_when(spark, d):
    e = read_table(spark, d, "events")
    return e.select("event_id", F.when(F.col("event_type") == "purchase", "Purchase")
                    .when(F.weekday("ts") < 5, "Weekday").otherwise("Weekend").alias("day_type"))


@query("pivot_longer", with_ctes(PA, body="SELECT brand, quarter, name, value FROM (SELECT brand, quarter, qty, price, discount, tax FROM pa) UNPIVOT (value FOR name IN (qty, price, discount, tax))"))
def pivot_longer(spark, d):
    df, _ = part_attrs(spark, d)
    return rs.pivot_longer(df, ["brand", "quarter"], ["qty", "price", "discount", "tax"])


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("pivot_wider", with_ctes(TL, body="SELECT month, " + ", ".join(
    f"max(y) FILTER (segment = '{s}') AS {s}" for s in SEGMENTS) + " FROM (SELECT month, segment, sum(y) AS y FROM tl GROUP BY ALL) GROUP BY month"))
def pivot_wider(spark, d):
    df, _ = trade_leaves(spark, d)
    return rs.pivot_wider(df.groupBy("month", "segment").agg(F.sum("y").alias("y")), ["month"], "segment", SEGMENTS, "y")


@query("distinct", "SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders")
def distinct(spark, d):
    return read_table(spark, d, "orders").select("o_orderpriority", "o_orderstatus").distinct()


@query("key_data", with_ctes(TL, body="SELECT region, nation, segment, count(*) AS rows FROM tl GROUP BY ALL"))
def key_data(spark, d):
    df, spec = trade_leaves(spark, d)
    return df.groupBy(*spec.by).agg(F.count("*").alias("rows"))


# ---- joins and set operations ------------------------------------------

@query("left_join", """SELECT o_orderkey, c_mktsegment, c_acctbal FROM orders LEFT JOIN
  (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""")
def left_join(spark, d):
    c = read_table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_acctbal")
    return read_table(spark, d, "orders").select("o_orderkey", "o_custkey").join(c, "o_custkey", "left").drop("o_custkey")


_OUTL = """ou AS (SELECT event_type, hour, y FROM eh JOIN (
  SELECT event_type, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.75) AS q3 FROM eh GROUP BY 1) USING (event_type)
  WHERE y < q1 - 1.5 * (q3 - q1) OR y > q3 + 1.5 * (q3 - q1))"""


def _outliers(spark, d):
    df, spec = events_hourly(spark, d)
    rows = df.select("event_type", "hour", "y")
    return rows, iqr_outliers(rows, spec.by, "y", k=1.5)


@query("anti_join", with_ctes(EH, _OUTL, body="""SELECT event_type, hour, y FROM eh WHERE NOT EXISTS (SELECT 1 FROM ou
  WHERE ou.event_type = eh.event_type AND ou.hour = eh.hour AND ou.y IS NOT DISTINCT FROM eh.y)"""))
def anti_join(spark, d):
    rows, outliers = _outliers(spark, d)
    return rs.natural_join(rows, outliers, "left_anti")


@query("right_join", with_ctes(EH, _OUTL, body="SELECT event_type, hour, n FROM (SELECT event_type, hour FROM ou) LEFT JOIN eh USING (event_type, hour)"))
def right_join(spark, d):
    df, _ = events_hourly(spark, d)
    _, outliers = _outliers(spark, d)
    return rs.natural_join(df.select("event_type", "hour", "n"), outliers.drop("y"), "right")


@query("semi_membership", """SELECT event_id, ts FROM events WHERE strftime(ts, '%H:%M') IN
  (SELECT strftime(ts, '%H:%M') FROM events WHERE event_type = 'purchase')""")
def semi_membership(spark, d):
    e = read_table(spark, d, "events").withColumn("clock", F.date_format("ts", "HH:mm"))
    seen = e.where(F.col("event_type") == "purchase").select("clock").distinct()
    return e.join(seen, "clock", "left_semi").select("event_id", "ts")


@query("union_all", with_ctes(OM, body="""SELECT 'level' AS type, priority, month, y FROM om
  UNION ALL SELECT 'log', priority, month, ln(y + 1) FROM om"""))
def union_all(spark, d):
    df, _ = orders_monthly(spark, d)
    base = df.select("priority", "month", "y")
    return rs.union_all({"level": base, "log": base.withColumn("y", F.log(F.col("y") + 1))}, "type")


# ---- aggregation, sorting, limits --------------------------------------

@query("summarise_by_index", with_ctes(OM, body="SELECT month, sum(y) AS total FROM om GROUP BY month"))
def summarise_by_index(spark, d):
    df, spec = orders_monthly(spark, d)
    return df.groupBy(spec.index).agg(F.sum("y").alias("total"))


@query("summarise_by_group", with_ctes(TL, body="SELECT region, month, sum(y) AS y FROM tl GROUP BY ALL"))
def summarise_by_group(spark, d):
    df, _ = trade_leaves(spark, d)
    return df.groupBy("region", "month").agg(F.sum("y").alias("y"))


@query("index_by", """SELECT event_type, CAST(ts AS DATE) AS date, count(*) AS n,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) / 1e2 AS total, max(value) AS top, bool_or(value > 100) AS any_large FROM events GROUP BY ALL""")
def index_by_(spark, d):
    from chronoloom.operators.index import index_by
    from chronoloom.plans.base import cents
    e = read_table(spark, d, "events").select("event_type", "ts", "value")
    return index_by(e, ["event_type"], "ts", "day", [
        F.count("*").alias("n"), (F.sum(cents("value")) / 1e2).alias("total"), F.max("value").alias("top"),
        F.bool_or(F.col("value") > 100).alias("any_large")], "date")


@query("aggregate_functions", """SELECT l_returnflag, count(*) AS n, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi,
  CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) / 1e2 / count(*) AS mean, bool_or(l_discount > 0.09) AS any_discount,
  quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25) AS iqr
  FROM lineitem GROUP BY l_returnflag""")
def aggregate_functions(spark, d):
    from chronoloom.plans.base import cents
    li = read_table(spark, d, "lineitem").select("l_returnflag", "l_extendedprice", "l_discount")
    plain = li.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi"),
        (F.sum(cents("l_extendedprice")) / 1e2 / F.count("*")).alias("mean"),
        F.bool_or(F.col("l_discount") > 0.09).alias("any_discount"))
    q = group_quantiles(li, ["l_returnflag"], "l_extendedprice", {"median": 0.5, "q1": 0.25, "q3": 0.75})
    return plain.join(q.select("l_returnflag", "median", (F.col("q3") - F.col("q1")).alias("iqr")), "l_returnflag")


@query("arrange", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def arrange(spark, d):
    return read_table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey")


@query("head", with_ctes(SD, body="SELECT flag, day, n FROM (SELECT *, row_number() OVER (PARTITION BY flag ORDER BY t) AS r FROM sd) WHERE r <= 6"))
def head_(spark, d):
    df, spec = ship_daily(spark, d)
    return head(df, spec.by, F.col("t"), F.floor(F.col("t") / 366), 6).select("flag", "day", "n")


@query("tail", with_ctes(SD, body="SELECT flag, day, n FROM (SELECT *, row_number() OVER (PARTITION BY flag ORDER BY t DESC) AS r FROM sd) WHERE r <= 14"))
def tail_(spark, d):
    df, spec = ship_daily(spark, d)
    return tail(df, spec.by, F.col("t"), F.floor(F.col("t") / 366), 14).select("flag", "day", "n")


@query("topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 4")
def topk(spark, d):
    return read_table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(4)


@query("group_line_sum", with_ctes(TL, body="SELECT segment, month, sum(y) AS y FROM tl GROUP BY ALL"))
def group_line_sum(spark, d):
    df, _ = trade_leaves(spark, d)
    return df.groupBy("segment", "month").agg(F.sum("y").alias("y"))
