"""Index, gaps, future rows, window-style verbs and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.functions import calendar as cal
from chronoloom.functions import transforms as tr
from chronoloom.operators import index as ix
from chronoloom.operators.blocks import lag_columns, row_numbers
from chronoloom.plans.base import (
    EH, OM, OM_RAW, SD, SD_RAW, events_hourly, events_hourly_raw, orders_monthly, raw_orders_monthly, ship_daily,
    ship_daily_raw, with_ctes)
from chronoloom.plans.catalog import query
from chronoloom.series import duplicates, to_series, update_index
from chronoloom.sources.tables import read_table


@query("to_series", with_ctes(SD_RAW, body="SELECT flag, day, t, n FROM sdr"))
def to_series_(spark, d):
    df, _ = ship_daily_raw(spark, d)
    out, _ = to_series(df.drop("t"), ["flag"], "day", "day", check=True)
    return out.select("flag", "day", "t", "n")


@query("duplicates", "SELECT o_orderpriority, o_orderdate, count(*) AS rows FROM orders GROUP BY ALL HAVING count(*) > 1")
def duplicates_(spark, d):
    return duplicates(read_table(spark, d, "orders"), ["o_orderpriority"], "o_orderdate")


@query("infer_interval", with_ctes(EH.split(",\nehc")[0], body="""SELECT event_type, min(g) AS interval FROM (
  SELECT event_type, t - lag(t) OVER (PARTITION BY event_type ORDER BY t) AS g FROM ehr) GROUP BY event_type"""))
def infer_interval(spark, d):
    df, spec = events_hourly_raw(spark, d)
    return ix.infer_interval(df, spec)


@query("update_index", "SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS rn, value FROM events")
def update_index_(spark, d):
    e = read_table(spark, d, "events").select("user_id", "ts", "value")
    counted = ix.row_number_index(e, ["user_id"], "ts")
    series, spec = to_series(e, ["user_id"], "ts", "minute", check=False)
    out, _ = update_index(counted, spec, index="rn", unit="int", regular=True)
    return out.select("user_id", F.col("t").alias("rn"), "value")


@query("row_number_index", "SELECT event_type, ts, row_number() OVER (PARTITION BY event_type ORDER BY ts) AS rn FROM events")
def row_number_index(spark, d):
    e = read_table(spark, d, "events").select("event_type", "ts")
    return ix.row_number_index(e, ["event_type"], "ts")


@query("row_number_in_group", "SELECT user_id, ts, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts) AS h FROM events")
def row_number_in_group(spark, d):
    e = read_table(spark, d, "events").select("user_id", "ts", F.to_date("ts").alias("day"))
    return row_numbers(e, ["user_id", "day"], F.col("ts"), F.hour("ts"), "h").drop("day")


@query("reverse_index", "SELECT event_type, ts, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) AS rn FROM events")
def reverse_index(spark, d):
    e = read_table(spark, d, "events").select("event_type", "ts")
    return ix.row_number_index(e, ["event_type"], "ts", reverse=True)


@query("difference", with_ctes(OM, body="""SELECT priority, month, d12, d12 - lag(d12) OVER (PARTITION BY priority ORDER BY t) AS d12_1 FROM (
  SELECT *, ln(y + 1) - lag(ln(y + 1), 12) OVER (PARTITION BY priority ORDER BY t) AS d12 FROM om)"""))
def difference(spark, d):
    df, spec = orders_monthly(spark, d)
    df = df.withColumn("ly", F.log(F.col("y") + 1))
    out = ix.difference(ix.difference(df, spec, "ly", "d12", 12), spec, "d12", "d12_1", 1)
    return out.select("priority", "month", "d12", "d12_1")


@query("lag_pairs", with_ctes(OM, body="""SELECT a.priority, a.month, month(a.month) AS season, a.y, CAST(k.k AS INTEGER) AS lag, b.y AS lagged
  FROM om a JOIN (SELECT unnest(range(1, 10)) AS k) k ON true JOIN om b ON a.priority = b.priority AND a.t = b.t + k.k"""))
def lag_pairs(spark, d):
    df, spec = orders_monthly(spark, d)
    wide = lag_columns(df, spec, {f"l{k}": ("y", k) for k in range(1, 10)})
    cells = F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"l{k}").alias("lagged")) for k in range(1, 10)])
    return (wide.withColumn("c", F.explode(cells)).where("c.lagged IS NOT NULL")
                .select("priority", "month", F.month("month").cast("long").alias("season"), "y", "c.lag", "c.lagged"))


@query("stretch", with_ctes(OM, body="""SELECT priority, month, y, CAST(fold AS BIGINT) AS fold FROM (
  SELECT *, row_number() OVER (PARTITION BY priority ORDER BY t) AS i, count(*) OVER (PARTITION BY priority) AS n FROM om) r
  JOIN (SELECT unnest(range(1, 1000)) AS fold) f ON i <= 3 + (fold - 1) AND 3 + (fold - 1) <= n"""))
def stretch(spark, d):
    df, spec = orders_monthly(spark, d)
    return ix.stretch(df, spec, init=3).select("priority", "month", "y", "fold")


@query("fill_gaps", with_ctes(EH, body="SELECT event_type, hour, t, n, y FROM eh"))
def fill_gaps(spark, d):
    df, _ = events_hourly(spark, d)
    return df.select("event_type", "hour", "t", "n", "y")


@query("fill_gaps_full", with_ctes(OM_RAW, body="""SELECT p.priority, make_date(g.t // 12, g.t % 12 + 1, 1) AS month, y FROM
  (SELECT DISTINCT priority FROM omr) p JOIN (SELECT unnest(range(min(t), max(t) + 1)) AS t FROM omr) g ON true
  LEFT JOIN omr ON omr.priority = p.priority AND omr.t = g.t"""))
def fill_gaps_full(spark, d):
    df, spec = raw_orders_monthly(spark, d)
    return ix.fill_gaps(df, spec, full=True)[0].select("priority", "month", "y")


@query("new_data", with_ctes(SD, body="""SELECT flag, CAST(DATE '1970-01-01' + CAST(m + h AS INTEGER) AS DATE) AS day, CAST(h AS INTEGER) AS h
  FROM (SELECT flag, max(t) AS m FROM sd GROUP BY flag), (SELECT unnest(range(1, 29)) AS h)"""))
def new_data(spark, d):
    df, spec = ship_daily(spark, d)
    return ix.new_data(df, spec, 28).select("flag", "day", "h")


@query("scenarios", with_ctes(SD, body="""SELECT scenario, flag, CAST(DATE '1970-01-01' + CAST(m + h AS INTEGER) AS DATE) AS day, CAST(h * step AS DOUBLE) AS x
  FROM (SELECT flag, max(t) AS m FROM sd GROUP BY flag), (SELECT unnest(range(1, 5)) AS h),
       (SELECT 'Increase' AS scenario, 1 AS step UNION ALL SELECT 'Decrease', -1)"""))
def scenarios(spark, d):
    df, spec = ship_daily(spark, d)
    future = ix.new_data(df, spec, 4)
    out = ix.scenarios(future, {"Increase": {"x": F.col("h")}, "Decrease": {"x": -F.col("h")}})
    return out.select("scenario", "flag", "day", "x")


@query("business_calendar_map", with_ctes(EH, body="""SELECT event_type, hour, cnt + row_number() OVER (PARTITION BY event_type ORDER BY hour) AS t_open FROM (
  SELECT event_type, cnt, TIMESTAMP '1970-01-01' + INTERVAL 1 HOUR * (m + h) AS hour FROM
    (SELECT event_type, max(t) AS m, count(*) AS cnt FROM eh WHERE isodow(hour) <= 5 AND hour(hour) BETWEEN 9 AND 16 GROUP BY 1),
    (SELECT unnest(range(1, 337)) AS h))
  WHERE isodow(hour) <= 5 AND hour(hour) BETWEEN 9 AND 16"""))
def business_calendar_map(spark, d):
    df, spec = events_hourly(spark, d)
    is_open = (F.weekday("hour") < 5) & F.hour("hour").between(9, 16)
    history = row_numbers(df.where(is_open), spec.by, F.col("t"), F.floor(F.col("t") / 720), "t_open")
    return ix.business_calendar(history, spec.by, "hour", "hour", 14 * 24)


@query("calendar_functions", """SELECT event_id, year(ts) AS year, quarter(ts) AS quarter, year(ts) || ' Q' || quarter(ts) AS yearquarter,
  strftime(ts, '%Y %b') AS yearmonth, isoyear(ts) || ' W' || lpad(CAST(week(ts) AS VARCHAR), 2, '0') AS yearweek, CAST(ts AS DATE) AS date,
  dayofweek(ts) + 1 AS wday, isodow(ts) AS wday_mon, strftime(ts, '%a') AS wday_label, strftime(ts, '%H:%M:%S') AS clock FROM events""")
def calendar_functions(spark, d):
    e = read_table(spark, d, "events")
    ts = F.col("ts")
    return e.select("event_id", F.year(ts).cast("long").alias("year"), F.quarter(ts).cast("long").alias("quarter"),
                    cal.yearquarter_label(ts).alias("yearquarter"), cal.yearmonth_label(ts).alias("yearmonth"),
                    cal.yearweek_label(ts).alias("yearweek"), F.to_date(ts).alias("date"),
                    cal.wday(ts).cast("long").alias("wday"), cal.wday(ts, 1).cast("long").alias("wday_mon"),
                    F.date_format(ts, "E").alias("wday_label"), F.date_format(ts, "HH:mm:ss").alias("clock"))


@query("month_arithmetic", with_ctes(OM, body="""SELECT priority, CAST(m - to_months(CAST(k AS INTEGER)) AS DATE) AS month, CAST(k AS INTEGER) AS k FROM (
  SELECT priority, min(month) AS m FROM om GROUP BY 1), (SELECT unnest(range(1, 16)) AS k)"""))
def month_arithmetic(spark, d):
    df, _ = orders_monthly(spark, d)
    first = df.groupBy("priority").agg(F.min("month").alias("m"))
    return first.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(15)))).select(
        "priority", F.add_months("m", -F.col("k")).alias("month"), "k")


@query("math", """SELECT l_orderkey, l_linenumber, ln(l_extendedprice) AS lg, sqrt(l_quantity) AS sq, exp(-l_discount) AS ex,
  round(l_tax, 1) AS rd, greatest(l_quantity, 25) AS pm, l_quantity * l_quantity AS p2, l_extendedprice / 1e6 AS mn, CAST(l_tax > 0.04 AS INTEGER) AS ind FROM lineitem""")
def math_(spark, d):
    li = read_table(spark, d, "lineitem")
    q = F.col("l_quantity")
    return li.select("l_orderkey", "l_linenumber", F.log("l_extendedprice").alias("lg"), F.sqrt(q).alias("sq"),
                     F.exp(-F.col("l_discount")).alias("ex"), F.round("l_tax", 1).alias("rd"),
                     F.greatest(q, F.lit(25.0)).alias("pm"), (q * q).alias("p2"),
                     (F.col("l_extendedprice") / 1e6).alias("mn"), (F.col("l_tax") > 0.04).cast("int").alias("ind"))


@query("strings", """SELECT p_partkey, 'part ' || p_partkey || ': ' || p_name AS label, p_brand || '/' || p_size AS pasted, contains(p_name, 'red') AS detected,
  starts_with(p_brand, 'Brand#2') AS starts, CAST(p_size AS VARCHAR) AS size_text, printf('%05d', p_size) AS padded FROM part""")
def strings(spark, d):
    p = read_table(spark, d, "part")
    return p.select("p_partkey", F.format_string("part %d: %s", "p_partkey", "p_name").alias("label"),
                    F.concat_ws("/", "p_brand", "p_size").alias("pasted"), F.contains("p_name", F.lit("red")).alias("detected"),
                    F.startswith("p_brand", F.lit("Brand#2")).alias("starts"), F.col("p_size").cast("string").alias("size_text"),
                    F.format_string("%05d", "p_size").alias("padded"))


@query("null_tests", with_ctes(EH, body="SELECT event_type, count(*) AS hours, count(*) FILTER (y IS NOT NULL) AS present FROM eh GROUP BY 1"))
def null_tests(spark, d):
    df, _ = events_hourly(spark, d)
    return df.groupBy("event_type").agg(F.count("*").alias("hours"), F.count_if(F.col("y").isNotNull()).alias("present"))


@query("box_cox", with_ctes(OM, body="SELECT priority, month, (pow(y + 1, 0.3) - 1) / 0.3 AS w, ln(y + 1) AS w0, y + 1 AS back FROM om"))
def box_cox(spark, d):
    df, _ = orders_monthly(spark, d)
    y = F.col("y") + 1
    return df.select("priority", "month", tr.box_cox(y, 0.3).alias("w"), tr.box_cox(y, 0).alias("w0"),
                     tr.inv_box_cox(tr.box_cox(y, 0.3), 0.3).alias("back"))


@query("scaled_logit", with_ctes(SD, body="SELECT flag, day, ln((y + 1) / (5000 - y)) AS w, y AS back FROM sd"))
def scaled_logit(spark, d):
    df, _ = ship_daily(spark, d)
    f = tr.scaled_logit(-1, 5000)
    return df.select("flag", "day", f.forward(F.col("y")).alias("w"), f.inverse(f.forward(F.col("y"))).alias("back"))
