"""Token ids in Parquet files that can be read selectively.

Documents lie in ascending id order over files and within them.  A row has the
document's id, its number of tokens, its place in its file (in tokens) and its
ids.  Ids are dictionary encoded (a vocabulary fits one dictionary page, so an
id takes the bits its number needs), document ids and places are delta encoded;
row groups and pages are small enough, and indexed, for reading a few documents
or only the metadata.  A second small table, one row per file, says at which
token of the whole collection the file starts.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from chronoloom.llm.common import scratch_folder, slices
from chronoloom.llm.merge_replay import gather

ROW_GROUP, PAGE, PAGE_ROWS = 32 << 20, 256 << 10, 512
REMEMBERED = 300_000
FILE = "doc_id long, n_tokens long, place long, ids array<int>"
_ENCODERS: dict[str, "ChunkEncoder"] = {}


class _Chunks(dict):
    def __missing__(self, chunk: bytes) -> int:
        value = self[chunk] = len(self)
        return value


def _bytes(words: pa.Array) -> list[bytes]:
    """The strings of an array without nulls, cut from its buffer."""
    if not len(words):
        return []
    _, offsets, data = words.cast(pa.binary()).buffers()
    ends = np.frombuffer(offsets, np.int32)[words.offset:words.offset + len(words) + 1].tolist()
    data = data.to_pybytes() if data else b""
    return [data[a:b] for a, b in zip(ends, ends[1:])]


class ChunkEncoder:
    """Ids of texts for a tokenizer that lower-cases and whose words hold no white space.

    Each distinct word is encoded once, a bounded number of words is remembered,
    and documents are put together from them.  ASCII letters
    are lowered first and punctuation after a letter is encoded apart, as the
    tokenizer itself would do both; texts that could hold a special token are
    left as they are.
    """

    MARKS = ".,;:!?*#%&$|)"
    #: Words of Latin letters: one word for the tokenizer, in composed form, lowered letter by letter.
    LATIN = "^[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+$"
    #: Runs that one call encodes, and Latin words that go to the tokenizer's model as one text.
    CALL, LINE = 4_096, 256

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        bytes_ = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        #: The letter that stands for each byte in the model's vocabulary; Latin words hold a-z and pairs of C3 and one of 80 to BF.
        self.letters = np.zeros(256, "<u4")
        for c in (" ", *map(chr, range(ord("a"), ord("z") + 1))):
            self.letters[ord(c)] = ord(c)
        for c in map(chr, range(0xc0, 0x100)):
            self.letters[list(c.encode())] = [ord(x) for x in bytes_.pre_tokenize_str(c)[0][0]]
        vocab, last = self.tokenizer.get_vocab(), self.tokenizer.model.end_of_word_suffix
        #: Whether an id is the last one of a word; None where the model does not tell.
        self.last = None
        if last and all(chr(c) + x in vocab for c in self.letters[self.letters > 32].tolist() for x in ("", last)):
            self.last = np.zeros(max(vocab.values()) + 1, bool)
            self.last[[i for name, i in vocab.items() if name.endswith(last)]] = True
        self.forget()

    def forget(self) -> None:
        self.chunks, self.flat, self.ends, self.seen = _Chunks(), np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def forget_rare(self) -> None:
        """Keep the half of the runs that came up most."""
        keep = np.sort(np.argsort(-self.seen, kind="stable")[:REMEMBERED // 2])
        names = list(self.chunks)
        self.chunks = _Chunks((names[i], n) for n, i in enumerate(keep.tolist()))
        self.flat, self.ends, self.seen = gather(self.flat, self.ends, keep), np.cumsum(np.diff(self.ends, prepend=0)[keep]), self.seen[keep]

    def _ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, one after the other, and the size of each.

        Latin words go to the tokenizer's model, as its own first steps would
        hand them on, many in one text; others through all steps.
        """
        plain = np.asarray(pc.match_substring_regex(texts, self.LATIN)) & (self.last is not None)
        some, rest = np.flatnonzero(plain), np.flatnonzero(~plain)
        words = pc.utf8_lower(texts.take(pa.array(some)))
        cuts = np.append(np.arange(0, len(some), self.LINE), len(some))
        lines = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), words), " ").cast(pa.binary()).to_pylist()
        lines = [self.letters[np.frombuffer(line, np.uint8)].tobytes().decode("utf-32-le") for line in lines]
        found = self.model.encode_batch_fast(lines, add_special_tokens=False)
        ours = np.fromiter(chain.from_iterable([e.ids for e in found]), np.uint32)
        size = np.diff(np.flatnonzero(self.last[ours]), prepend=-1) if len(some) else np.empty(0, np.int64)
        ids, others = [], texts.take(pa.array(rest)).to_pylist()
        for a in range(0, len(others), self.CALL):
            ids += [e.ids for e in self.tokenizer.encode_batch_fast(others[a:a + self.CALL], add_special_tokens=False)]
        size = np.append(size, np.fromiter(map(len, ids), np.int64, len(ids)))
        flat = np.append(ours, np.fromiter(chain.from_iterable(ids), np.uint32))
        order = np.argsort(np.append(some, rest))
        return gather(flat, np.cumsum(size), order), size[order]

    def _words(self, runs: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """Heads and the marks behind them are words of their own: distinct words, and of each run the one or two it holds (-1: none)."""
        heads = pc.ascii_rtrim(runs, characters=self.MARKS)
        cut = np.asarray(pc.and_(pc.and_(pc.less(pc.binary_length(heads), pc.binary_length(runs)), pc.match_substring_regex(heads, "[0-9A-Za-z]$")),
                                 pc.invert(pc.match_substring(runs, "<|"))))
        at = np.flatnonzero(cut)
        own = pc.if_else(pa.array(cut), heads, runs)
        size = np.asarray(pc.binary_length(heads))[at].tolist()
        marks = pa.array([r[n:] for r, n in zip(_bytes(runs.take(pa.array(at))), size)], pa.binary()).cast(pa.string())
        words = pa.concat_arrays([own, marks]).dictionary_encode()
        both = np.full((len(runs), 2), -1, np.int64)
        both[:, 0], both[at, 1] = np.asarray(words.indices)[:len(runs)], np.asarray(words.indices)[len(runs):]
        return words.dictionary, both

    def encode(self, texts: pa.Array | list[str], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the end of each text; ``end`` is appended to each text."""
        if len(self.chunks) > REMEMBERED:
            self.forget_rare()
        if end is not None and not self.chunks:  # white space stands for the end of a text: no chunk contains it
            self.chunks[b"\n"] = 0
            self.flat, self.ends, self.seen = np.array([end], np.uint32), np.array([1]), np.array([2**40])
        old = len(self.chunks)
        number = self.chunks.__getitem__
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        texts = pc.fill_null(texts, "")
        lists = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts)))
        runs = lists.flatten().dictionary_encode()
        words, both = self._words(runs.dictionary)
        names = _bytes(words)
        known = np.fromiter(map(number, names), np.int64, len(names))
        both = np.where(both < 0, -1, known[both])[np.asarray(runs.indices)]
        there = both >= 0
        at = np.append(0, np.cumsum(there.sum(axis=1)))[np.asarray(lists.offsets)[1:] - np.asarray(lists.offsets)[0]]
        every = both[there]
        if end is not None:
            every = np.insert(every, at, 0)
            at = at + np.arange(1, len(at) + 1)
        if len(self.chunks) > old:
            flat, size = self._ids(words.take(pa.array(np.flatnonzero(known >= old))))
            base = self.ends[-1] if old else 0
            self.flat = np.concatenate([self.flat, flat])
            self.ends = np.concatenate([self.ends, base + np.cumsum(size)])
        self.seen = np.append(self.seen, np.zeros(len(self.chunks) - len(self.seen), np.int64)) + np.bincount(every, minlength=len(self.chunks))
        to = np.append(0, np.cumsum(np.diff(self.ends, prepend=0)[every]))
        return gather(self.flat, self.ends, every), to[at]


def encode_documents(docs: DataFrame, tokenizer_path: str, end: int | None = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``FILE`` in ascending id order over the tasks; equal ids by a hash of their text."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _ENCODERS:
            _ENCODERS[tokenizer_path] = ChunkEncoder(tokenizer_path)
        enc, place = _ENCODERS[tokenizer_path], 0
        for part in slices(parts, "text", 2 << 20):
            ids, ends = enc.encode(part.column("text"), end)
            sizes = np.diff(ends, prepend=0)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes), pa.array(place + ends - sizes),
                 pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids.view(np.int32)))],
                ["doc_id", "n_tokens", "place", "ids"])
            place += int(ends[-1])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    return texts.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(batches, FILE)


def write_tokens(rows: DataFrame, path: str) -> None:
    """``path``/tokens and ``path``/starts (file, first_doc, last_doc, n_docs, n_tokens, start)."""
    spark = rows.sparkSession
    (rows.write.option("compression", "zstd").option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.block.size", ROW_GROUP).option("parquet.page.size", PAGE).option("parquet.page.row.count.limit", PAGE_ROWS)
     .option("parquet.enable.dictionary#doc_id", "false").option("parquet.enable.dictionary#place", "false")
     .parquet(f"{path}/tokens"))
    files = read_tokens(spark, path, "doc_id", "n_tokens").groupBy(_file()).agg(
        F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"), F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    # one row per file; files are numbered in the order of the documents
    before = Window.orderBy(F.length("file"), "file").rowsBetween(Window.unboundedPreceding, -1)
    files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).write.parquet(f"{path}/starts")


def _file() -> Column:
    return F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).alias("file")


def read_tokens(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Only the given columns are read; filters on doc_id skip row groups and pages."""
    return spark.read.schema(FILE).parquet(f"{path}/tokens").select(*columns, "_metadata")


def token_index(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens and further columns of the files."""
    starts = spark.read.parquet(f"{path}/starts").select("file", F.col("start").alias("file_start"))
    rows = read_tokens(spark, path, "doc_id", "n_tokens", "place", *columns).withColumn("file", _file())
    return rows.join(starts, "file").select("doc_id", (F.col("file_start") + F.col("place")).alias("start"), "n_tokens", *columns)


def read_span(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """Documents that touch tokens start..stop of the collection, with the ids of just that span."""
    low, high = F.greatest(F.lit(start) - F.col("start"), F.lit(0)), F.least(F.lit(stop) - F.col("start"), F.col("n_tokens"))
    rows = token_index(spark, path, "ids").where((F.col("start") < stop) & (F.col("start") + F.col("n_tokens") > start))
    return rows.select("doc_id", "start", F.slice("ids", (low + 1).cast("int"), (high - low).cast("int")).alias("ids"))


def checksums(rows: DataFrame) -> DataFrame:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers, beside the other columns."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            lists = part.column("ids")
            ends, flat = np.asarray(lists.offsets), np.asarray(lists.values).astype("<u4", copy=False)
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(crc, pa.int64())],
                                             ["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(batches, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenized(docs: DataFrame, tokenizer_path: str, end: int | None = 1, path: str | None = None) -> DataFrame:
    """Encode, write, and read back: doc_id, start, n_tokens, ids_crc32.

    Null and empty texts hold the end id only; a very long text is one row, and
    a worker holds its ids while it writes them.  Rows that repeat an id are rows
    of their own, next to each other; rows without id come first.  An empty
    table writes no rows.
    """
    spark = docs.sparkSession
    path = path or scratch_folder(spark, "tokens")
    write_tokens(encode_documents(docs, tokenizer_path, end), path)
    return checksums(token_index(spark, path, "ids"))
