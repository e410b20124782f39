"""Near duplicates on word shingles: fast similarity sketches, banding, exact verification.

A sketch has K coordinates.  In round i every shingle hashes to one coordinate
and offers (i, hash); a coordinate keeps the smallest offer.  After round K the
coordinate i - K is offered to directly, so all are filled after 2K rounds at
the latest; a set with many shingles is done after one.  Two sketches agree in a
coordinate with the Jaccard similarity as probability, with tail bounds as if
coordinates were independent.  32 bands of 4 coordinates miss a pair at 0.75
with probability 5e-6, at 0.8 with 4e-8.

No group is paired with itself: equal sets are one representative, and the
members of a bucket are first compared with its smallest member only.  Buckets
that then still hold several components are compared with a random member each,
round after round while that finds links: in a large group of near copies nearly
all become one component, each round in as many pairs as members.  What is then
left in such buckets is joined exactly on rare shingles (prefix and position
filters), which finds every remaining link between their documents.  Every link is
confirmed on the full sets of 64-bit shingle hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from chronoloom.llm.common import WordHashes, mix64, slices, written
from chronoloom.llm.components import components

BANDS, ROWS = 32, 4
#: Rounds of random members as centres, at most; what they leave is joined exactly.
TURNS = 6
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def constants(n: int, seed: int) -> np.ndarray:
    """Odd multipliers, the same everywhere."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def shingle_set(words: list[bytes], cache: WordHashes, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of ``width`` consecutive words; of the whole sequence where there are fewer."""
    if not words:
        return np.empty(0, np.uint64)
    h = cache.array(words)
    c = constants(width, 5)
    n = len(words)
    if n < width:
        total = np.array([np.uint64(n)])
        for j in range(n):
            total = total + h[j:j + 1] * c[j:j + 1]
    else:
        total = np.zeros(n - width + 1, np.uint64)
        for j in range(width):
            total += h[j:n - width + 1 + j] * c[j]
    return np.unique(mix64(total))


def sketches(sets: list[np.ndarray], k: int = BANDS * ROWS) -> np.ndarray:
    """One row of k coordinates for each set; all are filled unless the set is empty."""
    table = np.full(len(sets) * k, FULL, np.uint64)
    if not sets:
        return table.reshape(0, k)
    elements = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets), dtype=np.int64), [len(s) for s in sets])
    salts = constants(2 * k, 77)
    for i in range(2 * k):
        if not len(elements):
            break
        v = mix64(elements * salts[i] + salts[i])
        place = (v % np.uint64(k)).astype(np.int64) if i < k else np.full(len(v), i - k, np.int64)
        np.minimum.at(table, owner * k + place, (np.uint64(i) << np.uint64(55)) | (mix64(v) >> np.uint64(9)))
        open_ = (table.reshape(-1, k) == FULL).any(axis=1)
        if not open_.all():
            left = open_[owner]
            elements, owner = elements[left], owner[left]
    return table.reshape(-1, k)


def band_keys(table: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    c = constants(rows, 9)
    parts = table.reshape(len(table), bands, rows)
    total = np.zeros((len(table), bands), np.uint64)
    for j in range(rows):
        total += mix64(parts[:, :, j]) * c[j]
    return mix64(total + np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


SKETCH = "doc_id long, n long, digest binary, bands array<long>"
SETS = "doc_id long, n long, shingles array<long>"


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *[len(r) for r in rows]]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = WordHashes()
    for part in slices(batches, "text"):
        sets = [shingle_set(_words(t.as_py()), cache) for t in part.column("text")]
        keys = band_keys(sketches(sets))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
             _lists([k if len(s) else k[:0] for k, s in zip(keys, sets)])], ["doc_id", "n", "digest", "bands"])


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = WordHashes()
    for part in slices(batches, "text"):
        sets = [shingle_set(_words(t.as_py()), cache) for t in part.column("text")]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), _lists(sets)],
                                         ["doc_id", "n", "shingles"])


def _close(a: str, b: str):
    """Sizes that allow the similarity."""
    return 100 * F.least(a, b) >= 75 * F.greatest(a, b)


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("set_b"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return (both.select("a", "b", "n_a", "n_b", shared.alias("shared"))
            .where(100 * F.col("shared") >= 75 * (F.col("n_a") + F.col("n_b") - F.col("shared"))).select("a", "b"))


def _pairs(rows: DataFrame, a: str, b: str) -> DataFrame:
    return written(rows.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "pairs")


def _mixed(members: DataFrame, part: DataFrame) -> DataFrame:
    """Members of the buckets in which more than one component is left."""
    named = written(members.select("band", "d", "n").join(part, "d", "left").select("band", "d", "n", F.coalesce("component", "d").alias("comp")), "named")
    open_ = named.groupBy("band").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("band")
    return written(named.join(written(open_, "open"), "band", "left_semi"), "mixed")


def _by_rare_shingles(mixed: DataFrame, sets: DataFrame) -> DataFrame:
    """Every pair of documents from different components that can reach the similarity.

    Shingles are ordered by the number of documents that have them.  If two sets
    share k shingles, the first shared one stands at or before place n - k of
    either; a link needs 7 k >= 3 (n_a + n_b).  So only the rarest quarter of a
    set is joined, on equal shingles, and a document whose own shingles fill
    that quarter has no partner at all.  Per shingle, the documents outside the
    largest component meet those of the others.
    """
    docs = written(mixed.select("d", "n", "comp").distinct(), "open-docs")
    tokens = docs.select("d").join(sets.select(F.col("doc_id").alias("d"), "shingles"), "d").select("d", F.explode("shingles").alias("token"))
    shared = written(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "shared")
    own = tokens.join(shared, "token").groupBy("d").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("own"))
    lone = F.col("n") - F.size("own")
    quarter = F.col("n") - F.ceil(F.col("n") * 3 / 4) + 1
    rare = docs.join(own, "d").withColumn("lone", lone).withColumn("first", F.slice("own", F.lit(1), F.greatest(F.lit(0), quarter - lone).cast("int")))
    rare = written(rare.select("d", "n", "comp", "lone", F.posexplode("first").alias("i", "s"))
                   .select("d", "n", "comp", F.col("s.token").alias("token"), (F.col("lone") + F.col("i")).alias("at")), "rare")
    sizes = rare.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("size"))
    home = sizes.groupBy("token").agg(F.max(F.struct("size", "comp")).alias("h"), F.count(F.lit(1)).alias("k")).where("k > 1")
    home = written(home.select("token", F.col("h.comp").alias("home")), "home")
    outside = written(rare.join(home, "token").where("comp <> home"), "outside")
    other = rare.select("token", F.col("d").alias("e"), F.col("n").alias("n_e"), F.col("comp").alias("comp_e"), F.col("at").alias("at_e"))
    rest = outside.join(other, "token").where(
        (F.col("comp") != F.col("comp_e")) & _close("n", "n_e") & ((F.col("comp_e") == F.col("home")) | (F.col("d") < F.col("e")))
        & (7 * F.least(F.col("n") - F.col("at"), F.col("n_e") - F.col("at_e")) >= 3 * (F.col("n") + F.col("n_e"))))
    return _pairs(rest, "d", "e")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Null, empty and blank texts have an empty set and are their own component.
    Rows that share an id are one node.  An empty table gives an empty result.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketch = written(texts.mapInArrow(_sketch_batches, SKETCH), "sketches")
    reps = written(sketch.where("n > 0").groupBy("digest", "n").agg(F.min("doc_id").alias("rep")), "reps")
    of_rep = sketch.join(reps.select(F.col("rep").alias("doc_id"), "digest"), ["doc_id", "digest"], "left_semi")
    rows = written(of_rep.select(F.explode("bands").alias("band"), F.col("doc_id").alias("d"), "n"), "bands")
    # smallest member of every bucket with more than one
    first = rows.groupBy("band").agg(F.min(F.struct("d", "n")).alias("f"), F.max("d").alias("last")).where("f.d < last")
    buckets = written(first.select("band", F.col("f.d").alias("c"), F.col("f.n").alias("n_c")), "buckets")
    members = written(rows.join(buckets, "band"), "members")
    stars = members.where((F.col("d") != F.col("c")) & _close("n", "n_c")).select(F.col("c").alias("a"), F.col("d").alias("b"))
    stars = written(stars.distinct(), "stars")
    ids = members.select(F.col("d").alias("doc_id")).distinct()
    sets = written(texts.join(ids, "doc_id", "left_semi").mapInArrow(_set_batches, SETS), "sets")
    links = written(confirm(stars, sets), "confirmed")
    part = components(links).select(F.col("node").alias("d"), "component")

    # buckets that still hold several components: compared with a random member each, as long as that finds links
    mixed = members.select("band", "d", "n")
    for turn in range(TURNS):
        mixed = _mixed(mixed, part)
        draw = F.struct(F.xxhash64(F.lit(turn), "band", "d"), "d", "n", "comp")
        centres = mixed.groupBy("band").agg(F.min(draw).alias("c")).select("band", F.col("c.d").alias("c"), F.col("c.n").alias("n_c"), F.col("c.comp").alias("comp_c"))
        pairs = mixed.join(written(centres, "centres"), "band").where((F.col("comp") != F.col("comp_c")) & _close("n", "n_c"))
        more = written(confirm(_pairs(pairs, "d", "c"), sets), "more")
        if more.isEmpty():
            break
        links = written(links.unionByName(more), "links")
        part = components(links).select(F.col("node").alias("d"), "component")
    more = written(confirm(_by_rare_shingles(_mixed(mixed, part), sets), sets), "more")
    if not more.isEmpty():
        part = components(links.unionByName(more)).select(F.col("node").alias("d"), "component")

    named = reps.join(part.withColumnRenamed("d", "rep"), "rep", "left").select(
        "digest", F.coalesce("component", "rep").alias("component"))
    named = written(named, "named")
    out = sketch.select("doc_id", "n", "digest").join(named, "digest", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay: the one with the smallest id of every component."""
    kept = near_duplicates(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["_id"]), "left_semi")
