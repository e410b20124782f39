"""Byte-pair encoding of short words by a contiguous rank array, and decoding.

A word is held as its parts (the token at each boundary) and, beside them, the
rank of each part with its right neighbour.  One step looks through the ranks for
the smallest, the leftmost of equals; merges that pair; deletes the boundary between
the two, so that the array stays contiguous; and asks for the ranks of the new
part with its two neighbours.  All words of one length take their step together,
as rows of one matrix that loses a column a step.  Looking through all ranks
costs the square of the length, so words of more than SHORT parts keep their
parts in a linked list and their ranks in a heap; both give the same ids.

Texts fall into runs of characters that are not ASCII blanks; each distinct run
of a slice is normalised, split and encoded once.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from chronoloom.llm.common import slices
from chronoloom.llm.merge_replay import gather

#: Parts of the longest word for which the ranks are scanned.
SHORT = 256
#: Runs remembered between slices by one Python worker, and bytes of text in a slice.
REMEMBERED, SLICE = 300_000, 2 << 20
NONE = np.int32(2**31 - 1)

#: Runs of characters below U+0100, which are in composed form already; white space, and the start of a special token, are left out.
PLAIN = re.compile("(?:(?!<\\|)[^\x85\xa0Ā-\U0010ffff])+")
#: The split of the tokenizer for such runs in lower case, and a line feed between two runs.
PIECES = re.compile("\n|'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
                    "|[^\na-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+")
BLANK = re.compile(r"[\x20\x09-\x0D]")


class Merges:
    """Rank and result of joining two neighbouring tokens."""

    def __init__(self, vocab: dict[str, int], merges: list):
        pairs = [tuple(m) if isinstance(m, (list, tuple)) else tuple(m.split(" ")) for m in merges]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        self.result = np.array([vocab[a + b] for a, b in pairs] or [0], np.int32)
        order = np.argsort(key, kind="stable")[::-1]  # of a pair that is given twice the last rank counts
        _, first = np.unique(key[order], return_index=True)
        order = order[first]
        self.keys = np.append(key[order], np.int64(2**63 - 1))
        self.ranks = np.append(order.astype(np.int32), NONE)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        at = self.keys.searchsorted(key)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)


def merge_rows(parts: np.ndarray, merges: Merges) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Encode the rows of a matrix of equally long words; yields (row numbers, their ids) as rows finish."""
    rows = np.arange(len(parts))
    ranks = np.full(parts.shape, NONE, np.int32)
    if parts.shape[1] > 1:
        ranks[:, :-1] = merges.rank(parts[:, :-1], parts[:, 1:])
    while len(rows):
        i = ranks.argmin(axis=1)
        best = ranks[np.arange(len(rows)), i]
        done = best == NONE
        if done.any():
            yield rows[done], parts[done]
            go = ~done
            rows, parts, ranks, i, best = rows[go], parts[go], ranks[go], i[go], best[go]
            if not len(rows):
                return
        n, width = len(rows), parts.shape[1] - 1
        here, kept = np.arange(n), np.arange(width)
        parts[here, i] = merges.result[best]
        kept = kept + (kept > i[:, None])  # every boundary but the one right of the merged part
        parts, ranks = np.take_along_axis(parts, kept, 1), np.take_along_axis(ranks, kept, 1)
        ranks[here, i] = NONE
        right = here[i < width - 1]
        ranks[right, i[right]] = merges.rank(parts[right, i[right]], parts[right, i[right] + 1])
        left = here[i > 0]
        ranks[left, i[left] - 1] = merges.rank(parts[left, i[left] - 1], parts[left, i[left]])


def merge_long(parts: np.ndarray, merges: Merges) -> np.ndarray:
    """The same for one long word: a linked list of parts and a heap of (rank, place)."""
    token = parts.tolist()
    n = len(token)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    rank = [*merges.rank(parts[:-1], parts[1:]).tolist(), int(NONE)]
    heap = [(r, p) for p, r in enumerate(rank) if r != NONE]
    heapq.heapify(heap)
    pair = dict(zip(merges.keys[:-1].tolist(), merges.ranks[:-1].tolist()))
    while heap:
        r, p = heapq.heappop(heap)
        if rank[p] != r:
            continue
        q = after[p]
        token[p], rank[q], after[p] = int(merges.result[r]), -1, after[q]
        if after[q] < n:
            before[after[q]] = p
        for a in (p, before[p]):
            if a >= 0:
                b = after[a]
                rank[a] = pair.get(token[a] << 32 | token[b], int(NONE)) if b < n else int(NONE)
                if rank[a] != NONE:
                    heapq.heappush(heap, (rank[a], a))
    out, p = [], 0
    while p < n:
        out.append(token[p])
        p = after[p]
    return np.array(out, np.int32)


class WordEncoder:
    """Encoder and decoder for a tokenizer file with byte-level words that end in a suffix."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        model = spec["model"]
        self.merges, vocab = Merges(model["vocab"], model["merges"]), model["vocab"]
        alphabet = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # the tokenizer's character for each byte: seen on characters whose last byte it is; bytes that end none come from two-byte heads
        chars = {}
        for c in range(0x800):
            for byte, shown in zip(chr(c).encode(), alphabet.pre_tokenize_str(chr(c))[0][0]):
                chars[byte] = shown
        for text in ("ࠀက 　䀀倀怀瀀耀退ꀀ뀀쀀퀀",
                     "\U00010000\U00040000\U00080000\U000c0000\U00100000"):
            for byte, shown in zip(text.encode(), alphabet.pre_tokenize_str(text)[0][0]):
                chars[byte] = shown
        self.byte_of = {shown: byte for byte, shown in chars.items()}
        suffix = model.get("end_of_word_suffix") or ""
        self.inner, self.last = np.zeros(256, np.int32), np.zeros(256, np.int32)
        for byte, shown in chars.items():
            self.inner[byte], self.last[byte] = vocab[shown], vocab[shown + suffix]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        shown = [(names.get(i, "") + " ").encode() for i in range(max(names, default=-1) + 1)]
        self.shown, self.shown_ends = np.frombuffer(b"".join(shown), np.uint8), np.cumsum(np.fromiter(map(len, shown), np.int64, len(shown)))
        self.forget()

    def forget(self) -> None:
        self.runs: dict[str, int] = {}
        self.flat, self.ends, self.seen = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _forget_rare(self) -> None:
        keep = np.sort(np.argsort(-self.seen, kind="stable")[:REMEMBERED // 2])
        names = list(self.runs)
        self.runs = {names[i]: n for n, i in enumerate(keep.tolist())}
        self.flat, self.ends = gather(self.flat, self.ends, keep), np.cumsum(np.diff(self.ends, prepend=0)[keep])
        self.seen = self.seen[keep]

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words: (flat ids, size of each)."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        raw = np.frombuffer(b"".join(words), np.uint8)
        parts = self.inner[raw]
        parts[ends - 1] = self.last[raw[ends - 1]]
        numbers, ids, counts = [], [], []
        for n in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == n)
            matrix = parts[(ends[own] - n)[:, None] + np.arange(n)]
            if n > SHORT:
                found = ((own[j:j + 1], merge_long(row, self.merges)[None]) for j, row in enumerate(matrix))
            else:
                found = ((own[rows], out) for rows, out in merge_rows(matrix, self.merges))
            for which, out in found:
                numbers.append(which)
                ids.append(out.ravel())
                counts.append(np.full(len(which), out.shape[1], np.int64))
        if not numbers:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        number, count = np.concatenate(numbers), np.concatenate(counts)
        order = np.argsort(number)
        return gather(np.concatenate(ids), np.cumsum(count), order), count[order]

    def _odd(self, run: str) -> list[bytes | int]:
        """Words of a run by the tokenizer's own normaliser and splitter; special tokens stand as their ids."""
        out: list[bytes | int] = []
        for piece in self.cut.split(run) if self.cut else [run]:
            if piece in self.special:
                out.append(self.special[piece])
            elif piece:
                clean = self.library.normalizer.normalize_str(piece)
                out += [bytes(map(self.byte_of.__getitem__, w)) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(clean)]
        return out

    def _fresh(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words: dict[bytes, int] = {}
        number = words.setdefault
        plain = [i for i, r in enumerate(runs) if PLAIN.fullmatch(r)]
        index: list[list[int]] = [[]] * len(runs)
        special: dict[int, int] = {}  # number of a word that stands for a special token
        pieces = iter(PIECES.findall("\n".join([runs[i] for i in plain]).lower()))
        for i in plain:
            own = []
            for p in pieces:
                if p == "\n":
                    break
                own.append(number(p.encode(), len(words)))
            index[i] = own
        for i in sorted(set(range(len(runs))) - set(plain)):
            own = []
            for w in self._odd(runs[i]):
                if isinstance(w, int):
                    n = number(b"<|" + str(w).encode() + b" ", len(words))  # holds a blank, so no word looks like it
                    special[n] = w
                    own.append(n)
                else:
                    own.append(number(w, len(words)))
            index[i] = own
        flat, size = self.words(list(words))
        if special:
            which = np.array(sorted(special))
            keep = np.ones(len(size), bool)
            keep[which] = False
            body = gather(flat, np.cumsum(size), np.flatnonzero(keep))
            ones = np.array([special[n] for n in which.tolist()], np.int32)
            size = np.where(keep, size, 1)
            to = np.cumsum(size)
            flat = np.empty(int(to[-1]), np.int32)
            mark = np.zeros(len(flat), bool)
            mark[to[which] - 1] = True
            flat[mark], flat[~mark] = ones, body
        counts = np.fromiter(map(len, index), np.int64, len(index))
        every = np.fromiter((n for own in index for n in own), np.int64, int(counts.sum()))
        length = np.append(0, np.cumsum(size[every]))[np.cumsum(counts)]
        return gather(flat, np.cumsum(size), every), np.diff(length, prepend=0)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and the end of each text."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        lowered = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        lists = pc.ascii_split_whitespace(lowered)
        runs = lists.flatten().dictionary_encode()
        used = np.asarray(runs.indices).astype(np.int64)
        names = runs.dictionary.to_pylist()
        old = len(self.runs)
        number = self.runs.setdefault
        known = np.fromiter((number(r, len(self.runs)) for r in names), np.int64, len(names))
        if len(self.runs) > old:
            flat, size = self._fresh([names[i] for i in np.flatnonzero(known >= old).tolist()])
            base = self.ends[-1] if old else 0
            self.flat, self.ends = np.concatenate([self.flat, flat]), np.concatenate([self.ends, base + np.cumsum(size)])
            self.seen = np.append(self.seen, np.zeros(len(self.runs) - old, np.int64))
        every = known[used]
        self.seen += np.bincount(every, minlength=len(self.seen))
        ids = gather(self.flat, self.ends, every)
        to = np.append(0, np.cumsum(np.diff(self.ends, prepend=0)[every]))
        ends = to[np.asarray(lists.offsets)[1:] - np.asarray(lists.offsets)[0]]
        if len(self.runs) > REMEMBERED:
            self._forget_rare()
        return ids, ends

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Tokens of the ids, a blank behind each, and the end of each token."""
        text = gather(self.shown, self.shown_ends, ids)
        return text.tobytes(), np.cumsum(np.diff(self.shown_ends, prepend=0)[ids])


def parts_of(text: str, size: int) -> Iterator[str]:
    """Cut a long text at blanks; no word crosses a cut.  A run longer than ``size`` stays whole."""
    at = 0
    while len(text) - at > size:
        cut = BLANK.search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>, decoded string"
_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One per Python worker and tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def encoded(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids, decoded).

    The digests are over the ids as little-endian unsigned 32-bit integers and
    over the decoded text.  Null and empty texts have no tokens and decode to the
    empty text.  Rows are independent: repeated rows give repeated results, rows
    without id keep their null id, further columns are left out, an empty table
    gives no rows.  A very long text is cut at blanks and its digests go on over
    the parts, so a worker holds a slice, not the text's ids (with ``with_ids``
    the ids of one document are one value and are held).  ``tokenizer_path`` must exist
    on every executor.
    """
    def digests(enc: WordEncoder, texts: pa.Array):
        ids, ends = enc.encode(texts)
        shown, token_ends = enc.decode(ids)
        at = np.append(0, token_ends)
        for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
            yield ids[a:b].astype("<u4"), shown[at[a]:at[b]]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for part in slices(parts, "text", SLICE):
            texts = part.column("text")
            if part.num_rows == 1 and len(texts[0].as_py() or "") > 2 * SLICE:
                found = [list(map(list, zip(*(next(digests(enc, pa.array([t]))) for t in parts_of(texts[0].as_py(), SLICE)))))]
                found = [(ids, shown) for ids, shown in found]
            else:
                found = [([ids], [shown]) for ids, shown in digests(enc, texts)]
            rows = []
            for ids, shown in found:
                one, two, last = hashlib.sha256(), hashlib.sha256(), max((j for j, s in enumerate(shown) if s), default=-1)
                for j, (i, s) in enumerate(zip(ids, shown)):
                    one.update(i)
                    two.update(s[:-1] if j == last else s)
                rows.append((sum(map(len, ids)), one.hexdigest(), two.hexdigest()))
            n, one, two = zip(*rows)
            cols = [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(one), pa.array(two)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols += [pa.array([np.concatenate(ids).view(np.int32) for ids, _ in found], pa.list_(pa.int32())),
                         pa.array([b"".join(s)[:-1].decode() for _, s in found])]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(batches, ENCODED if with_ids else ENCODED.split(", ids array")[0])
