"""Byte-level BPE by replaying merges over the distinct words of a slice of the corpus.

A merge never crosses a word, so the corpus can be cut into slices.  In a slice
every distinct word is encoded once: an index from the rank of a pair to the
places where the pair stands drives the replay, the lowest rank first, all its
places at a time; a merge touches only its two neighbours.  Within a word this is the order in which a
word-by-word encoder merges: smallest rank, then leftmost.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from chronoloom.llm.common import slices

#: The characters with the Unicode property White_Space.
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Texts fall into blanks and runs of other characters, each with the blank before it; words lie within these.
CHUNK = re.compile(f" ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
#: Distinct chunks remembered by one Python worker, and how many a step may add before they are encoded.
REMEMBERED, FRESH = 250_000, 100_000
#: Bytes of text in a slice, bytes of words replayed at a time, and characters of a text that are numbered at a time.
SLICE, REPLAYED, NUMBERED = 2 << 20, 1 << 20, 1 << 19


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def replay(words: list[bytes], ranks: dict[bytes, int]) -> list[list[int]]:
    """Token ids of each distinct word."""
    done: list[list[int] | None] = [None] * len(words)
    parts: list[bytes] = []  # the token that starts at a place, None once it is merged away
    after: list[int] = []
    before: list[int] = []
    starts: list[int] = []
    word_of: list[int] = []
    places: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        starts.append(len(parts))
        whole = ranks.get(w)
        if whole is not None:
            done[i] = [whole]
            continue
        at, n = len(parts), len(w)
        for j in range(n):
            parts.append(w[j:j + 1])
            before.append(at + j - 1 if j else -1)
            after.append(at + j + 1 if j < n - 1 else -1)
            word_of.append(i)
            if j < n - 1:
                r = ranks.get(w[j:j + 2])
                if r is not None:
                    places.setdefault(r, []).append(at + j)
    heap = list(places)
    heapq.heapify(heap)
    while heap:
        r = heapq.heappop(heap)
        todo = places.pop(r, None)
        if not todo:
            continue
        todo.sort()
        wait = -1  # a word in which a pair of lower rank has come up: it goes first
        for p in todo:
            if word_of[p] == wait:
                if r not in places:
                    places[r] = []
                    heapq.heappush(heap, r)
                places[r].append(p)
                continue
            left = parts[p]
            q = after[p]
            if left is None or q < 0:
                continue
            joined = left + parts[q]
            if ranks.get(joined) != r:
                continue
            parts[p], parts[q] = joined, None
            z = after[q]
            after[p] = z
            if z >= 0:
                before[z] = p
                new = ranks.get(joined + parts[z])
                if new is not None:
                    if new not in places:
                        places[new] = []
                        heapq.heappush(heap, new)
                    places[new].append(p)
                    if new < r:
                        wait = word_of[p]
            a = before[p]
            if a >= 0:
                new = ranks.get(parts[a] + joined)
                if new is not None:
                    if new not in places:
                        places[new] = []
                        heapq.heappush(heap, new)
                    places[new].append(a)
                    if new < r:
                        wait = word_of[p]
    for i, w in enumerate(words):
        if done[i] is None:
            ids, p = [], starts[i] if w else -1
            while p >= 0:
                ids.append(ranks[parts[p]])
                p = after[p]
            done[i] = ids
    return done


class PairTable:
    """Rank of two neighbouring tokens, for arrays of token ids.  A token's id is its rank."""

    NONE = np.int32(2**31 - 1)

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, r in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(r)
        order = np.argsort(np.array(keys, np.int64)) if keys else np.empty(0, np.int64)
        self.keys = np.append(np.array(keys, np.int64)[order], np.int64(2**63 - 1))
        self.values = np.append(np.array(values, np.int32)[order], self.NONE)

    def get(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        at = self.keys.searchsorted(key)
        return np.where(self.keys[at] == key, self.values[at], self.NONE)


def replay_many(words: list[bytes], ranks: dict[bytes, int], pairs: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of many distinct words as (flat ids, end of each word): all places of a pair at a time.

    Where a merge brings up a pair of lower rank in a word in which the merge
    stood more than once, the order of that word matters; such words are encoded
    by ``replay``.
    """
    none = pairs.NONE
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer(b"".join(words), np.uint8)
    single = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
    token = single[flat]
    n = len(token)
    word = np.repeat(np.arange(len(words)), sizes)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    ends = np.cumsum(sizes)
    after[ends[sizes > 0] - 1] = -1
    before[(ends - sizes)[sizes > 0]] = -1
    rank = np.full(n, none, np.int32)
    inner = np.flatnonzero(after >= 0)
    rank[inner] = pairs.get(token[inner], token[inner + 1])
    alive = np.ones(n, bool)
    again: list[np.ndarray] = []
    # the index from pair to places
    places: dict[int, list[np.ndarray]] = {}

    def add(at: np.ndarray) -> None:
        own = rank[at]
        order = np.argsort(own, kind="stable")
        own, at = own[order], at[order]
        cuts = np.flatnonzero(own[1:] != own[:-1]) + 1
        begin = 0
        for end in [*cuts.tolist(), len(at)]:
            r = int(own[begin])
            if r in places:
                places[r].append(at[begin:end])
            else:
                places[r] = [at[begin:end]]
                heapq.heappush(heap, r)
            begin = end

    heap: list[int] = []
    known = np.flatnonzero(rank != none)
    if len(known):
        add(known)
    while heap:
        r = heapq.heappop(heap)
        lists = places.pop(r)
        p = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        p = p[rank[p] == r]
        if not len(p):
            continue
        q = after[p]
        chained = p[1:] == q[:-1]
        if chained.any():  # overlapping places: every other one of a chain
            i = np.arange(len(p))
            start = np.where(np.append(True, ~chained), i, 0)
            p = p[(i - np.maximum.accumulate(start)) % 2 == 0]
            q = after[p]
        z = after[q]
        has = z >= 0
        again_at = p[:0]
        if len(p) > 1:  # a lower pair with the right neighbour as it stands before that one merges, too
            right = pairs.get(np.full(int(has.sum()), r, np.int64), token[z[has]])
            again_at = p[has][right < r]
        token[p] = r
        after[p] = z
        alive[q] = False
        rank[q] = none
        before[z[has]] = p[has]
        rank[p] = none
        right = p[has]
        a = before[p]
        left = a[a >= 0]
        new = np.unique(np.concatenate([left, right]))
        if len(new):
            rank[new] = pairs.get(token[new], token[after[new]])
            new = new[rank[new] != none]
            if len(new):
                again_at = np.concatenate([again_at, new[rank[new] < r]])
                add(new)
        if len(again_at) and len(p) > 1:
            own, count = np.unique(word[p], return_counts=True)
            again.append(np.intersect1d(word[again_at], own[count > 1]))
    out, sizes = token[alive], np.bincount(word[alive], minlength=len(words))
    redo = np.unique(np.concatenate(again)) if again else np.empty(0, np.int64)
    # a word that is a token is one id, whatever merges lead to
    whole = [(i, r) for i, w in enumerate(words) if sizes[i] > 1 and (r := ranks.get(w)) is not None]
    fixed = dict(zip(redo.tolist(), replay([words[i] for i in redo.tolist()], ranks))) | {i: [r] for i, r in whole}
    if fixed:
        ends = np.cumsum(sizes)
        parts, last = [], 0
        for i in sorted(fixed):
            parts += [out[last:ends[i] - sizes[i]], np.array(fixed[i], np.int64)]
            last = ends[i]
            sizes[i] = len(fixed[i])
        out = np.concatenate([*parts, out[last:]])
    return out.astype(np.uint32), np.cumsum(sizes)


class _Chunks(dict):
    """Numbers chunks in the order in which they come up."""

    def __missing__(self, chunk: str) -> int:
        value = self[chunk] = len(self)
        return value


def gather(flat: np.ndarray, ends: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Concatenate the lists ``index`` of a table of lists."""
    size = np.diff(ends, prepend=0)
    n = size[index]
    to = np.cumsum(n)
    if not len(to):
        return flat[:0]
    return flat[np.arange(to[-1]) + np.repeat(ends[index] - size[index] - (to - n), n)]


class Encoder:
    """Encodes texts slice by slice; remembers a bounded number of chunks between slices."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pairs = ranks, PairTable(ranks)
        self.pattern = regex.compile(pattern)
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, i in ranks.items():
            self.bytes_of[i] = token
        self.forget()

    def forget(self) -> None:
        self.chunks, self.flat, self.ends, self.seen = _Chunks(), np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _forget_rare(self) -> None:
        """Keep the half of the chunks that came up most."""
        keep = np.sort(np.argsort(-self.seen, kind="stable")[:REMEMBERED // 2])
        names = list(self.chunks)
        self.chunks = _Chunks((names[i], n) for n, i in enumerate(keep.tolist()))
        self.flat, self.ends, self.seen = gather(self.flat, self.ends, keep), np.cumsum(np.diff(self.ends, prepend=0)[keep]), self.seen[keep]

    def _learn(self, chunks: list[str]) -> None:
        """Encode new chunks: their distinct words replay together, about REPLAYED bytes at a time."""
        words: dict[bytes, int] = {}
        cut, sizes, held = [], [], 0

        def settle():
            nonlocal words, cut, sizes, held
            flat, ends = replay_many(list(words), self.ranks, self.pairs)
            own = np.array(cut, np.int64)
            length = np.append(0, np.cumsum(np.diff(ends, prepend=0)[own]))[np.cumsum(sizes)]
            base = self.ends[-1] if len(self.ends) else 0
            self.flat, self.ends = np.concatenate([self.flat, gather(flat, ends, own)]), np.concatenate([self.ends, base + length])
            words, cut, sizes, held = {}, [], [], 0

        for c in chunks:
            own = [words.setdefault(w.encode("utf-8", "surrogatepass"), len(words)) for w in self.pattern.findall(c)]
            cut += own
            sizes.append(len(own))
            held += len(c)
            if held >= REPLAYED:
                settle()
        if sizes:
            settle()

    def _settle(self, pending: list[tuple[int, np.ndarray]], out: list[list[np.ndarray]]) -> None:
        known = len(self.ends)
        if len(self.chunks) > known:
            self._learn(list(self.chunks)[known:])
            self.seen = np.append(self.seen, np.zeros(len(self.chunks) - known, np.int64))
        for doc, numbers in pending:
            out[doc].append(gather(self.flat, self.ends, numbers))
            self.seen += np.bincount(numbers, minlength=len(self.seen))
        pending.clear()
        if len(self.chunks) > REMEMBERED:
            self._forget_rare()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text.  The table of chunks is looked at while texts are numbered, so it stays bounded within a text, too."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        pending: list[tuple[int, np.ndarray]] = []
        for doc, text in enumerate(texts):
            found = iter(CHUNK.findall(text)) if len(text) <= NUMBERED else (m.group() for m in CHUNK.finditer(text))
            while True:
                numbers = np.fromiter(map(self.chunks.__getitem__, islice(found, FRESH)), np.int32)
                if not len(numbers):
                    break
                pending.append((doc, numbers))
                if len(self.chunks) - len(self.ends) > FRESH:
                    self._settle(pending, out)
        self._settle(pending, out)
        return [np.concatenate(o) if len(o) > 1 else o[0] if o else np.empty(0, np.uint32) for o in out]

    def decode(self, ids: np.ndarray) -> bytes:
        table = self.bytes_of
        return b"".join([table[i] for i in ids.tolist()])


ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>"
_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One per Python worker and rank file."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(load_ranks(path), pattern)
    return _ENCODERS[path, pattern]


def encoded(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
            with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids).

    The digests are over the ids as little-endian unsigned 32-bit integers and
    over the decoded bytes.  Null and empty texts have no tokens.  Rows are
    independent: repeated rows give repeated results, an empty table none.  A very
    long text is numbered in steps, so beside its own ids a worker holds no more than for short ones.
    ``ranks_path`` must exist on every executor.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks_path, pattern)
        for part in slices(parts, "text", SLICE):
            ids = enc.encode([t or "" for t in part.column("text").to_pylist()])
            cols = [part.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<u4", copy=False)).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(enc.decode(x)).hexdigest() for x in ids])]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).view(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(batches, ENCODED if with_ids else ENCODED.rpartition(",")[0])
