"""Removal of repeated passages with sharded Aho-Corasick automata.

A window is 20 consecutive words.  Of the 15 six-word grams of a window the one
with the smallest hash (the last one on ties) is its anchor, so equal windows
have equal anchors; consecutive windows with the same anchor form a piece.
Pieces, not windows, are what moves: a piece is its text once, for about eight
windows.

1. Every document gives the anchor hashes of its pieces and the digest of its
   words.  Documents with the same words are one representative (the smallest
   id); the others are copies of it in full.
2. Anchors that occur once are dropped.  The text of the other pieces is dealt
   out by anchor.  A task reads its pieces anchor by anchor, collects about
   SHARD windows and compiles the passages that recur into one automaton over
   word numbers: whole pieces that stand in several places, and the windows that
   unlike pieces share.  The shard's distinct pieces are streamed through it;
   each hit that is not the first occurrence is a range to remove, in every place
   of the piece.
3. An anchor with more than HOT pieces (a line that a third of the documents
   share) does not fit a task: its windows are dealt out one by one by a 128-bit
   hash of their words, where partial minima find the first occurrence.  This is
   the exact way for the hot rest; no occurrence is dropped.
4. Ranges meet the texts of the documents that have any; all other documents
   keep the digest from step 1.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from chronoloom.llm.common import mix64, run_starts, slices, written
from chronoloom.llm.minhash import constants

WINDOW, GRAM = 20, 6
#: Pieces of one anchor that one task takes; windows in one automaton.
HOT, SHARD = 200, 40_000
#: Bytes of a word that is hashed by itself; the lowest 0 to 8 bytes of a number.
LONG, MASKS = 64, np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
EMPTY = hashlib.sha256(b"").hexdigest()

PRINTS = "doc_id long, digest binary, n_words long, sha string, anchors array<long>"
PIECES = "key long, hot boolean, low long, doc_id long, digest binary, start long, words binary"
RANGES = "doc_id long, digest binary, start long, stop long"
RESULT = "doc_id long, digest binary, n_removed long, kept_sha256 string, kept_text string"


def pieces_of(h: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, last window and anchor hash of each piece; ``h``: the word hashes of documents that end at ``ends``."""
    n = len(h) - WINDOW + 1
    if n <= 0:
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, np.uint64)
    c = constants(GRAM, 3)
    low = np.zeros(len(h) - GRAM + 1, np.uint64)
    for j in range(GRAM):
        low += h[j:len(low) + j] * c[j]
    low = mix64(low)
    at, width, span = np.arange(len(low)), 1, WINDOW - GRAM + 1
    while width < span:  # minima of twice the width, the last place on ties
        step = min(width, span - width)
        later = low[step:] <= low[:-step]
        low, at = np.where(later, low[step:], low[:-step]), np.where(later, at[step:], at[:-step])
        width += step
    whole = np.flatnonzero(np.repeat(ends, np.diff(ends, prepend=0))[:n] - np.arange(n) >= WINDOW)
    first = run_starts(at[whole])
    last = whole[np.append(first[1:], len(whole)) - 1] if len(whole) else whole
    return whole[first], last, low[whole[first]]


def window_hashes(h: np.ndarray, seed: int) -> np.ndarray:
    n = len(h) - WINDOW + 1
    c = constants(WINDOW, seed)
    total = np.zeros(n, np.uint64)
    for j in range(WINDOW):
        total += h[j:n + j] * c[j]
    return mix64(total)


class Words:
    """The words of some texts, one after the other."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = lists.flatten()
        there = np.asarray(pc.binary_length(words)) > 0  # white space at either end makes an empty word
        offsets = np.asarray(lists.offsets)
        #: Where each text begins and ends, in words.
        self.ends = np.append(0, np.cumsum(there))[offsets[1:] - offsets[0]]
        self.starts = np.append(0, self.ends[:-1])
        self.words = words if there.all() else words.filter(pa.array(there))
        #: All words joined by one space, and at which byte each of them begins.
        self.joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(self.words)], pa.int32()), self.words), " ")[0].as_buffer().to_pybytes()
        self.at = np.append(0, np.cumsum(np.asarray(pc.binary_length(self.words)).astype(np.int64) + 1))

    def passages(self, a: np.ndarray, b: np.ndarray) -> list[bytes]:
        """Words a to b (exclusive), joined by one space."""
        joined = self.joined
        return [joined[x:y] for x, y in zip(self.at[a].tolist(), (self.at[b] - 1).tolist())]

    def texts(self) -> list[bytes]:
        return [t if n else b"" for t, n in zip(self.passages(self.starts, self.ends), (self.ends - self.starts).tolist())]

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word: eight bytes of all words at a time, long words one by one."""
        size = np.diff(self.at) - 1
        eights = np.ndarray(len(self.joined) + 1, "<u8", self.joined + bytes(8), strides=(1,))
        h, left = mix64(size.astype(np.uint64)), np.flatnonzero(size <= LONG)
        for k in range(0, LONG, 8):
            left = left[size[left] > k]
            if not len(left):
                break
            h[left] = mix64(h[left] ^ (eights[self.at[left] + k] & MASKS[np.minimum(size[left] - k, 8)]))
        for i in np.flatnonzero(size > LONG).tolist():
            h[i] = xxhash.xxh3_64_intdigest(self.joined[self.at[i]:self.at[i] + size[i]])
        return h


def _digest(joined: bytes) -> bytes:
    return hashlib.blake2b(joined, digest_size=16).digest()


def _print_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        words = Words(part.column("text"))
        texts = words.texts()
        first, _, keys = pieces_of(words.hashes(), words.ends)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(list(map(_digest, texts)), pa.binary()), pa.array(words.ends - words.starts, pa.int64()),
             pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
             pa.ListArray.from_arrays(pa.array(np.append(0, np.searchsorted(first, words.ends)), pa.int32()), pa.array(keys.view(np.int64)))],
            ["doc_id", "digest", "n_words", "sha", "anchors"])


def _piece_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, digest, wanted: piece numbers, hot: of them the hot ones) to pieces."""
    for part in slices(batches, "text", 1 << 20):
        words = Words(part.column("text"))
        h = words.hashes()
        first, last, keys = pieces_of(h, words.ends)
        # another text under the same id has another digest
        own = np.fromiter(map(bytes.__eq__, map(_digest, words.texts()), part.column("digest").to_pylist()), bool, part.num_rows)
        lists = part.column("wanted")
        row = np.repeat(np.arange(part.num_rows), np.where(own, np.asarray(pc.list_value_length(lists)), 0))
        named = lists.filter(pa.array(own)).flatten()
        piece = np.searchsorted(first, words.starts)[row] + np.asarray(named.field("piece"))
        hot = np.asarray(named.field("hot").cast(pa.int8())) > 0

        def out(key, is_hot, low, row, at, texts):
            return pa.RecordBatch.from_arrays(
                [pa.array(key, pa.int64()), pa.array(np.full(len(row), is_hot)), pa.array(low, pa.int64()), part.column("doc_id").take(pa.array(row)),
                 part.column("digest").take(pa.array(row)), pa.array(at - words.starts[row], pa.int64()), texts],
                ["key", "hot", "low", "doc_id", "digest", "start", "words"])

        some, p = row[~hot], piece[~hot]
        yield out(keys.view(np.int64)[p], False, np.zeros(len(p), np.int64), some, first[p], pa.array(words.passages(first[p], last[p] + WINDOW), pa.binary()))
        if hot.any():
            some, p = row[hot], piece[hot]
            n = last[p] - first[p] + 1
            at = np.arange(n.sum()) + np.repeat(first[p] - (np.cumsum(n) - n), n)
            one, two = (window_hashes(h, seed).view(np.int64)[at] for seed in (11, 12))
            yield out(one, True, two, np.repeat(some, n), at, pa.nulls(len(at), pa.binary()))


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self) + 1
        return value


def locate(shard: list[tuple]) -> list[tuple]:
    """Ranges of all windows of the shard's pieces (anchor, doc_id, digest, start, words) that also start earlier.

    Words become numbers, recurring passages the patterns of one automaton, and
    every distinct piece is streamed through it.  A window has its anchor at one
    place, so no window stands twice in a piece: windows recur in copies of a
    piece, which are one pattern, or in unlike pieces of one anchor.
    """
    places: dict[bytes, list[tuple]] = {}
    alike: dict[int, list[bytes]] = {}
    for anchor, doc, digest, start, words in shard:
        known = places.get(words)
        if known is None:
            places[words] = [(doc, digest, start)]
            alike.setdefault(anchor, []).append(words)
        else:
            known.append((doc, digest, start))
    number = _Numbers().__getitem__
    sequences = {words: tuple(map(number, words.split(b" "))) for words in places}
    patterns = {sequences[words]: min(at) for words, at in places.items() if len(at) > 1}
    for group in alike.values():
        if len(group) == 1:
            continue
        seen: dict[tuple, tuple] = {}  # window -> first place
        for words in group:
            (doc, digest, start), seq = min(places[words]), sequences[words]
            for i in range(len(seq) - WINDOW + 1):
                window, place = seq[i:i + WINDOW], (doc, digest, start + i)
                known = seen.setdefault(window, place)
                if known is not place:
                    seen[window] = patterns[window] = min(known, place)
    if not patterns:
        return []
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for passage, first in patterns.items():
        automaton.add_word(passage, (len(passage), first))
    automaton.make_automaton()
    found = []
    for words, at in places.items():
        hits = [(end - n + 1, n, first) for end, (n, first) in automaton.iter(sequences[words])]
        for doc, digest, start in at:
            runs: list[list[int]] = []
            for i, n, first in hits:
                a = start + i
                if (doc, digest, a) <= first:
                    continue
                if runs and a <= runs[-1][1]:
                    runs[-1] = [min(runs[-1][0], a), max(runs[-1][1], a + n)]
                else:
                    runs.append([a, a + n])
            found += [(doc, digest, a, b) for a, b in runs]
    return found


def _locate_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by anchor: shards of whole anchors."""
    shard: list[tuple] = []
    key, windows = None, 0

    def out():
        cols = list(zip(*locate(shard))) or [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.int64(), pa.int64()))],
                                          ["doc_id", "digest", "start", "stop"])

    for batch in batches:
        numbers = [np.asarray(batch.column(c)).tolist() for c in ("key", "doc_id", "start")]
        for k, doc, start, digest, words in zip(*numbers, *[batch.column(c).to_pylist() for c in ("digest", "words")]):
            if k != key and windows >= SHARD:
                yield out()
                shard, windows = [], 0
            key = k
            shard.append((k, doc, digest, start, words))
            windows += words.count(b" ") - WINDOW + 2
    if shard:
        yield out()


def _keep_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        words, lists, rows = Words(part.column("text")), part.column("ranges"), []
        flat, offsets = lists.flatten(), np.append(0, np.cumsum(np.asarray(pc.list_value_length(lists)))).tolist()
        ranges = list(zip(*[np.asarray(flat.field(c)).tolist() for c in ("start", "stop")]))
        for i, (doc, digest, text, a, b) in enumerate(zip(part.column("doc_id").to_pylist(), part.column("digest").to_pylist(), words.texts(),
                                                          words.starts.tolist(), words.ends.tolist())):
            if _digest(text) != digest:
                continue
            spans, end = [], a
            for start, stop in sorted(ranges[offsets[i]:offsets[i + 1]]):
                if a + start > end:
                    spans.append((end, a + start))
                end = max(end, a + stop)
            if b > end:
                spans.append((end, b))
            joined = b" ".join(words.passages(*np.array(spans, np.int64).reshape(-1, 2).T))
            rows.append((doc, digest, b - a - sum(y - x for x, y in spans), hashlib.sha256(joined).hexdigest(), joined.decode("utf-8", "surrogatepass")))
        cols = list(zip(*rows)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.string()))],
                                         ["doc_id", "digest", "n_removed", "kept_sha256", "kept_text"])


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (and kept_text where words were removed).

    Null, empty and short texts (under 20 words) lose nothing.  Rows that share
    id and words count as one document, reported once for each row.  Rows with
    the same id and other words are ordered by the digest of their words.  Rows
    without id are compared as whole texts only.  An empty table gives an empty
    result.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    prints = written(texts.mapInArrow(_print_batches, PRINTS), "prints")
    long_ = prints.where(F.col("n_words") >= WINDOW)
    reps = written(long_.groupBy("digest").agg(F.min("doc_id").alias("rep")), "reps")
    named = reps.select("digest", F.col("rep").alias("doc_id"))
    anchors = written(long_.select("doc_id", "digest", "anchors").join(named, ["doc_id", "digest"], "left_semi")
                      .dropDuplicates(["doc_id", "digest"]).withColumn("uid", F.xxhash64("doc_id", "digest")), "anchors")
    rows = anchors.select("uid", F.posexplode("anchors").alias("piece", "key"))
    again = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "again")
    wanted = rows.join(again, "key").groupBy("uid").agg(
        F.collect_list(F.struct("piece", (F.col("n") > hot).alias("hot"))).alias("wanted"))
    # the texts of the documents that hold such pieces, once; later steps read this table
    own = anchors.select("uid", "doc_id", "digest").join(wanted, "uid").drop("uid")
    held = written(texts.join(own, "doc_id"), "held")
    pieces = written(held.mapInArrow(_piece_batches, PIECES), "pieces")

    cool = pieces.where(~F.col("hot")).select("key", "doc_id", "digest", "start", "words")
    spread = cool.repartition("key").sortWithinPartitions("key")
    ranges = spread.mapInArrow(_locate_batches, RANGES)
    warm = pieces.where("hot")
    place = F.struct("doc_id", "digest", "start")
    firsts = written(warm.groupBy("key", "low").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "firsts")
    late = warm.join(firsts, ["key", "low"]).where(place != F.col("first")).select(
        "doc_id", "digest", "start", (F.col("start") + WINDOW).alias("stop"))
    ranges = ranges.unionByName(late).groupBy("doc_id", "digest").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    cut = written(held.select("doc_id", "text", "digest").join(ranges, ["doc_id", "digest"])
                  .select("doc_id", "text", "digest", "ranges").mapInArrow(_keep_batches, RESULT), "cut")

    info = prints.select("doc_id", "digest", "n_words", "sha").join(reps, "digest", "left")
    copy = F.col("rep").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("rep"))
    out = info.join(cut.dropDuplicates(["doc_id", "digest"]), ["doc_id", "digest"], "left")
    columns = ["doc_id", "n_words",
               F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
               F.when(copy, F.lit(EMPTY)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256")]
    if with_text:
        columns.append(F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"))
    return out.select(*columns)
