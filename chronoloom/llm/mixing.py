"""Mixing sources to target weights by Pareto order sampling.

Every source gets a share of the words of the mix.  A source whose target is r
times its size gives floor(r) whole copies of each document for certain.  The
words that are then missing come from a sample with unequal chances: a
document's inclusion chance is in proportion to its size, so every word of a
source is as likely to be drawn as any other within a document that is not
certain; where that would pass 1 the document is one more certain whole copy, and
the chances of the others rise until the expected words are the missing ones.
Documents are ranked by random odds over inclusion odds, and the first ones are
taken until the missing words are reached.  Random numbers are hashes of the
document, so reruns agree.

The order is cut into buckets by its rank value against the source's mean odds: sums
per bucket locate the bucket in which a source reaches its target; only the
rows of that bucket, a bounded number, are walked in order.  What is too long
there is left out and the gap goes on to the buckets behind, round by round,
until no open document fits.  A hot source costs partial sums, never a sort of
its rows in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from chronoloom.llm.common import WORD, text_or_empty, written

#: Rows of one source in one bucket of the order, about.
BUCKET = 1_000


def n_words(column: str = "text") -> Column:
    return F.regexp_count(text_or_empty(column), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """One row per source: source_size, n_docs, target.

    Weights repeat over the sources in code point order, null last; together the
    targets are the size of all documents.  A target above ``most`` times its
    source stops there and the excess goes to the others by weight.  This works
    on one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    per = per.withColumn("roof", F.col("source_size") * F.lit(float(most))).withColumn("level", F.col("roof") / F.col("weight"))
    # sources in the order in which a rising level reaches their roofs
    rising = Window.orderBy("level", F.col("source").isNull(), F.col("source"))
    everything = Window.partitionBy()
    per = per.withColumn("left_words", F.sum("source_size").over(everything)
                         - F.coalesce(F.sum("roof").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    per = per.withColumn("left_weight", F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing)))
    per = per.withColumn("at", F.col("left_words") / F.col("left_weight"))
    final = F.max(F.when(F.col("at") > F.col("level"), None).otherwise(F.struct(-F.col("level"), F.col("at").alias("at")))).over(everything)
    return per.select("source", "source_size", "n_docs", "weight",
                      F.coalesce(F.least(F.col("weight") * final["at"], F.col("roof")), F.col("roof")).alias("target"))


def uniform(seed: int, *columns: str) -> Column:
    """A number strictly between 0 and 1 from a hash of the columns."""
    return (F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0, seed: int = 20, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", bucket: int = BUCKET) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies.

    ``taken`` is ``copies * size`` words; ``chance`` is the inclusion chance of one
    more copy (1 where it is certain, 0 where a source needs none).  Null texts have size 0; documents of
    size 0 are not drawn.  Null sources form one source.  Repeated rows are
    documents of their own and share a rank.
    """
    sizes = written(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
                                n_words(text_col).alias("size"), F.xxhash64(text_or_empty(text_col)).alias("mark")), "sizes")
    targets = written(source_targets(sizes, weights, most), "targets")
    chances = written(_chances(sizes, targets), "chances")
    df = _on_source(_on_source(sizes, targets), chances).withColumn("u", uniform(seed, "doc_id", "mark"))
    certain = F.col("size") > F.col("edge_size")
    df = df.withColumn("whole", F.coalesce(F.floor(_rate()), F.lit(0)) + F.when(certain, 1).otherwise(0))
    # chance of one more copy; 0 where there is none or it is certain
    df = df.withColumn("part", F.when((F.col("size") > 0) & (F.col("gap0") > 0) & ~certain,
                                      F.least(F.lit(1.0), F.col("slope") * F.col("size"))).otherwise(F.lit(0.0)))
    odds = F.col("u") / (1 - F.col("u"))
    df = df.withColumn("rank", F.when(F.col("part") > 0, odds * (1 - F.col("part")) / F.col("part")))
    # against the mean odds of the source and brought back to (0, 1): buckets of like numbers of rows
    mean = F.least(F.col("gap0") / F.col("source_size"), F.lit(1 - 1e-9))
    against = F.col("rank") * mean / (1 - mean)
    spread = F.coalesce(against / (1 + against), F.lit(1.0))
    df = df.withColumn("bucket", F.floor(spread * F.greatest(F.lit(1), F.floor(F.col("n_docs") / bucket))))
    open_ = df.where((F.col("part") > 0) & (F.col("size") > 0))
    ranges, picked, gaps = _fill(open_)
    df = _on_source(df, ranges)
    in_range = F.exists("ranges", lambda r: (F.col("bucket") >= r["first"]) & (F.col("bucket") < r["edge"]) & (F.col("size") <= r["gap"]))
    df = df.withColumn("ranged", F.coalesce(in_range, F.lit(False)))
    picked = picked.unionByName(_nearest(df, picked, gaps))
    df = _on_row(df, picked)
    extra = (F.col("part") > 0) & (F.col("size") > 0) & (F.col("ranged") | F.col("p_mark").isNotNull())
    copies = F.col("whole") + F.when(extra, 1).otherwise(0)
    return df.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).cast("long").alias("taken"),
                     copies.cast("int").alias("copies"),
                     F.when(F.col("size") > F.col("edge_size"), 1.0).otherwise(F.col("part")).alias("chance"))


def _rate() -> Column:
    return F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))


def _chances(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: edge_size, slope, gap0.

    After the copies that all documents have in common, documents longer than
    ``edge_size`` get one more for certain; the others have the chance slope *
    size, which adds up to ``gap0`` expected words.  This works on one row per
    source and size.
    """
    per = sizes.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    per = _on_source(per, targets).withColumn("gap", F.col("target") - F.floor(_rate()) * F.col("source_size"))
    words = (F.col("n") * F.col("size")).cast("double")
    down = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    up = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    per = per.withColumn("above", F.coalesce(F.sum(words).over(down), F.lit(0.0))).withColumn("squares", F.sum(words * F.col("size")).over(up))
    per = per.withColumn("slope", (F.col("gap") - F.col("above")) / F.col("squares"))
    # the longest size whose chance is no more than 1 when all longer ones are certain
    fits = (F.col("gap") > 0) & (F.col("slope") * F.col("size") <= 1 + 1e-9)
    best = per.groupBy("source").agg(F.max(F.when(fits, F.struct(
        F.col("size").alias("edge_size"), "slope", (F.col("gap") - F.col("above")).alias("gap0")))).alias("b"))
    return best.where("b IS NOT NULL").select("source", "b.edge_size", "b.slope", "b.gap0")


def _fill(open_: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Take what fits, in rank order over all buckets of each source.

    Each round leaves out rows longer than the gap, takes the buckets that then
    fit as a whole and walks the one that does not; the gap that remains goes on
    to the buckets behind it, until no open row fits.  Returns per source the
    ranges taken (first bucket, edge, longest row), the rows picked in the edges
    and the last gaps.
    """
    gaps = written(open_.groupBy("source").agg(
        F.lit(0).cast("long").alias("first"), F.max("gap0").alias("gap")), "gaps")
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges, picked, last = [], [], []
    while True:
        fitting = _on_source(open_, gaps).where((F.col("bucket") >= F.col("first")) & (F.col("size") <= F.col("gap")))
        cuts = fitting.groupBy("source", "bucket", "first", "gap").agg(F.sum("size").alias("words"))
        cuts = cuts.withColumn("missing", F.col("gap") - F.coalesce(F.sum("words").over(before), F.lit(0)))
        # the first bucket that does not fit as a whole
        fits = F.col("words") <= F.col("missing")
        edges = cuts.groupBy("source", "first", "gap").agg(
            F.min(F.when(~fits, F.struct("bucket", "missing"))).alias("edge"), F.min(F.when(fits, F.col("missing") - F.col("words"))).alias("rest"))
        edges = written(edges.select("source", "first", "gap", F.coalesce("edge.bucket", F.lit((1 << 63) - 1)).alias("edge"), F.col("edge.missing"),
                                     "rest"), "edges")
        ranges.append(edges.select("source", F.struct("first", "edge", "gap").alias("range")))
        cut = edges.where("missing IS NOT NULL").select("source", F.col("edge").alias("bucket"), "missing")
        # sources without an edge are done: all that fits is taken
        last.append(edges.where("missing IS NULL").select("source", F.col("rest").alias("gap")))
        if cut.isEmpty():
            break
        rows = _on_source(fitting, cut.withColumnRenamed("bucket", "edge")).where(F.col("bucket") == F.col("edge"))
        walked = written(_walk_edge(rows.select("source", "doc_id", "mark", "size", "rank", "missing")), "walked")
        picked.append(walked.select("source", F.inline("got")))
        on = walked.join(cut.withColumnRenamed("source", "_src"), walked["source"].eqNullSafe(F.col("_src")))
        gaps = written(on.select("source", (F.col("bucket") + 1).alias("first"), "gap"), "gaps")
        # a source in which nothing fits any more has no edge in the next round, and keeps this gap
        last.append(gaps.select("source", "gap"))
    none = open_.limit(0).select("source", F.col("doc_id").alias("p_id"), F.col("mark").alias("p_mark"))
    every = reduce(DataFrame.unionByName, ranges).groupBy("source").agg(F.collect_list("range").alias("ranges"))
    left = reduce(DataFrame.unionByName, last).groupBy("source").agg(F.min("gap").alias("left"))
    return written(every, "ranges"), reduce(DataFrame.unionByName, picked, none), written(left, "left")


def _nearest(df: DataFrame, picked: DataFrame, gaps: DataFrame) -> DataFrame:
    """Per source the shortest row not taken, if one more than fits comes nearer to the target."""
    rest = _on_source(df.where((F.col("part") > 0) & (F.col("size") > 0) & ~F.col("ranged")), gaps).where(F.col("size") < 2 * F.col("left"))
    rest = _on_row(rest, picked).where("p_mark IS NULL")
    alike = rest.groupBy("source", "doc_id", "mark", "rank", "left").agg(F.sum("size").alias("size")).where(F.col("size") < 2 * F.col("left"))
    best = alike.groupBy("source").agg(F.min(F.struct("size", "rank", F.col("doc_id").alias("p_id"), F.col("mark").alias("p_mark"))).alias("b"))
    return written(best.select("source", "b.p_id", "b.p_mark"), "nearest")


def _on_row(df: DataFrame, picked: DataFrame) -> DataFrame:
    return df.join(picked.withColumnRenamed("source", "_s"), (df["source"].eqNullSafe(F.col("_s"))) & df["doc_id"].eqNullSafe(F.col("p_id"))
                   & (df["mark"] == F.col("p_mark")), "left").drop("_s", "p_id")


def _on_source(df: DataFrame, per_source: DataFrame) -> DataFrame:
    """Join columns that exist once per source (null is a source)."""
    own = per_source.withColumnRenamed("source", "_src")
    return df.join(own, df["source"].eqNullSafe(own["_src"]), "left").drop("_src")


def _walk_edge(rows: DataFrame) -> DataFrame:
    """In each source's edge bucket, in rank order: take what still fits.  One row per source: what it got, and the gap that stays.

    Rows that repeat (same id and text) are taken together or not at all.
    """
    alike = rows.groupBy("source", "doc_id", "mark", "rank", "missing").agg(F.sum("size").alias("size"))
    lists = alike.groupBy("source", "missing").agg(F.array_sort(F.collect_list(F.struct("rank", "doc_id", "mark", "size"))).alias("rows"))
    none = F.slice(F.transform("rows", lambda r: F.struct(r["doc_id"].alias("p_id"), r["mark"].alias("p_mark"))), 1, 0)
    start = F.struct(F.col("missing").cast("double").alias("gap"), none.alias("got"))

    def step(s, r):
        fits = r["size"] <= s["gap"]
        me = F.struct(r["doc_id"].alias("p_id"), r["mark"].alias("p_mark"))
        return F.struct(F.when(fits, s["gap"] - r["size"]).otherwise(s["gap"]).alias("gap"),
                        F.when(fits, F.concat(s["got"], F.array(me))).otherwise(s["got"]).alias("got"))

    return lists.select("source", F.aggregate("rows", start, step).alias("end")).select("source", "end.gap", "end.got")


def repeated(docs: DataFrame, **kw) -> DataFrame:
    """The mixed documents themselves, with their own columns: each as often as it was taken."""
    taken = mix(docs, **kw).where("copies > 0").groupBy(F.col("doc_id").alias("_mix_id"), F.col("size").alias("_mix_size")).agg(
        F.max("copies").alias("_mix_copies"))
    own = docs.withColumn("_mix_n", n_words())
    joined = own.join(taken, F.col("doc_id").eqNullSafe(F.col("_mix_id")) & (F.col("_mix_n") == F.col("_mix_size")))
    return joined.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies")))).select(*docs.columns)
