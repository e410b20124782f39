"""Toxicity by a lexicon with misspellings and context windows.

The lexicon is learned from labelled documents: words whose documents are toxic
far more often than others.  Its terms form two tries, one of them backwards.  A
word with one edit has its first or its second half intact, so the automaton of
all words within one edit walks one half exactly and spends the edit in the
other; both walks end after a few letters for most words.  How much a misspelling
of a term counts is learned from the labelled documents as well.

Hits get a context window: those inside quotation marks are summed apart from
the others, and the densest window of a document is a feature of its own.  A
logistic model joins these sums to a score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chronoloom.llm.common import held_out, slices, training_labels, written

#: Labelled rows to learn from, terms in the lexicon: bounds of what the driver sees.
LABELLED, TERMS = 200_000, 20_000
SUPPORT, LEAST_ODDS, LEAST_LENGTH, WINDOW = 3, 2.0, 5, 10
REMEMBERED = 250_000
EDGES = b".,;:!?\"'()[]{}<>*#%&$~^|/\\-_=+`@"
OPENING, CLOSING = tuple(x.encode() for x in "\"“„«‹‘'`"), tuple(x.encode() for x in "\"”“»›’'`")
FEATURES = ["f_plain", "f_misspelt", "f_quoted", "f_dense"]
SCORED = "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES)


def bare(word: bytes) -> bytes:
    """Lower case without punctuation around it."""
    return word.strip(EDGES).decode("utf-8", "replace").lower().strip("“”„«»‹›‘’¿¡…—–").encode()


class Lexicon:
    """Terms with weights, and the automaton of words within one edit of a term."""

    END = -1

    def __init__(self, terms: list[bytes]):
        self.terms = {t: i for i, t in enumerate(terms)}
        self.forward: dict = {}
        self.backward: dict = {}
        self.heads: set[str] = set()  # what the intact first or second half of a misspelt term can be
        self.tails: set[str] = set()
        for t, i in self.terms.items():
            letters = t.decode()
            if len(letters) >= LEAST_LENGTH:
                for root, way in ((self.forward, letters), (self.backward, letters[::-1])):
                    for c in way:
                        root = root.setdefault(c, {})
                    root[self.END] = i
                for n in range(len(letters) + 1):
                    self.heads.add(letters[:n])
                    self.tails.add(letters[n:])

    def misspelt(self, word: bytes) -> int | None:
        """A term one edit away (the smallest number), or None."""
        w = word.decode()
        if len(w) < LEAST_LENGTH - 1:
            return None
        half = len(w) // 2
        if w[:half] not in self.heads and w[half:] not in self.tails:
            return None
        found = [*self._spend(self.forward, w, half), *self._spend(self.backward, w[::-1], len(w) - half)]
        return min(found, default=None)

    def _spend(self, node: dict, w: str, intact: int) -> Iterator[int]:
        for c in w[:intact]:
            node = node.get(c)
            if node is None:
                return
        i = intact
        while True:
            for c, child in node.items():
                if c != self.END:
                    yield from self._exact(child, w, i)  # a letter of the term is missing
                    if i < len(w):
                        yield from self._exact(child, w, i + 1)  # another letter
            if i == len(w):
                return
            yield from self._exact(node, w, i + 1)  # a letter too many
            node = node.get(w[i])
            if node is None:
                return
            i += 1

    def _exact(self, node: dict, w: str, i: int) -> Iterator[int]:
        while i < len(w):
            node = node.get(w[i])
            if node is None:
                return
            i += 1
        if self.END in node:
            yield node[self.END]


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def word_counts(labelled: DataFrame) -> DataFrame:
    """(word, pos, neg): in how many toxic and other documents each word occurs."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms: dict[bytes, bytes] = {}
        for part in slices(parts, "text", 8 << 20):
            counts = (Counter(), Counter())
            if len(forms) > REMEMBERED:
                forms.clear()
            for text, y in zip(part.column("text").to_pylist(), part.column("y").to_pylist()):
                own = set()
                for w in set(_split(text)):
                    f = forms.get(w)
                    if f is None:
                        f = forms[w] = bare(w)
                    own.add(f)
                counts[1 if y else 0].update(own)
            words = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([counts[1][w] for w in words], pa.int64()),
                                              pa.array([counts[0][w] for w in words], pa.int64())], ["word", "pos", "neg"])

    each = labelled.select("text", "y").mapInArrow(batches, "word binary, pos long, neg long")
    return each.groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def learn_lexicon(counts: DataFrame, n_pos: int, n_neg: int) -> tuple[list[bytes], list[float], list[float]]:
    """Terms, their log odds, and the log odds of words one edit away from each.  At most TERMS terms reach the driver."""
    odds = F.log((F.col("pos") + 0.5) / (n_pos + 1.0)) - F.log((F.col("neg") + 0.5) / (n_neg + 1.0))
    top = (counts.withColumn("odds", odds).where((F.col("pos") >= SUPPORT) & (F.col("odds") >= LEAST_ODDS) & (F.length("word") > 1))
           .orderBy((F.col("pos") * F.col("odds")).desc(), "word").limit(TERMS).select("word", "odds").collect())
    terms, weights = [bytes(r[0]) for r in top], [float(r[1]) for r in top]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms)
        for part in parts:
            sums: dict[int, list[int]] = {}
            for w, pos, neg in zip(*[part.column(c).to_pylist() for c in ("word", "pos", "neg")]):
                if w not in lexicon.terms and (t := lexicon.misspelt(w)) is not None:
                    s = sums.setdefault(t, [0, 0])
                    s[0] += pos
                    s[1] += neg
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s[0] for s in sums.values()], pa.int64()),
                                              pa.array([s[1] for s in sums.values()], pa.int64())], ["term", "pos", "neg"])

    near = counts.mapInArrow(batches, "term int, pos long, neg long").groupBy("term").agg(F.sum("pos"), F.sum("neg")).collect() if terms else []
    edited = [w / 2 for w in weights]
    for t, pos, neg in near:
        own = math.log((pos + 0.5) / (n_pos + 1.0)) - math.log((neg + 0.5) / (n_neg + 1.0))
        n = min(pos + neg, 50)
        edited[t] = max(0.0, (n * own + 5 * edited[t]) / (n + 5))
    return terms, weights, edited


def _quoted(words: list[bytes], at: int) -> bool:
    """Whether a quotation opens before the word and closes at or after it, within the window."""
    low, high = max(0, at - WINDOW), min(len(words), at + WINDOW + 1)
    opened = False
    for w in words[low:at + 1]:
        if w.startswith(OPENING):
            opened = True
        if w.rstrip(b".,;:!?").endswith(CLOSING) and w is not words[at] and len(w) > 1:
            opened = False
    return opened and any(w.rstrip(b".,;:!?").endswith(CLOSING) for w in words[at:high])


def features(docs: DataFrame, terms: list[bytes], weights: list[float], edited: list[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms)

        class Hits(dict):
            """Two generations of words: those that keep coming up are not looked up anew."""

            before: dict = {}

            def __missing__(self, word: bytes):
                if len(self) > REMEMBERED:
                    self.before = dict(self)
                    self.clear()
                hit = self.before.get(word, self)
                if hit is self:
                    form = bare(word)
                    t = lexicon.terms.get(form)
                    if t is not None:
                        hit = (t, weights[t], False)
                    else:
                        t = lexicon.misspelt(form)
                        hit = (t, edited[t], True) if t is not None and edited[t] > 0 else None
                self[word] = hit
                return hit

        known = Hits()
        for part in slices(parts, "text"):
            rows = []
            for text in part.column("text").to_pylist():
                words = _split(text)
                hits = [(i, h) for i, h in enumerate(map(known.__getitem__, words)) if h is not None]
                best: list[dict[int, float]] = [{}, {}, {}]
                dense = inside = 0.0
                tail = 0
                for j, (i, (t, w, wrong)) in enumerate(hits):
                    kind = 2 if _quoted(words, i) else 1 if wrong else 0
                    best[kind][t] = w
                    inside += w * (kind != 2)
                    while hits[tail][0] < i - WINDOW:
                        k, (_, old, _) = hits[tail]
                        inside -= old * (not _quoted(words, k))
                        tail += 1
                    dense = max(dense, inside)
                rows.append([*(math.log1p(sum(b.values())) for b in best), math.log1p(dense)])
            m = np.array(rows, float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(m[:, j]) for j in range(len(FEATURES))]], ["doc_id", *FEATURES])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(batches, SCORED)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Coefficients, the constant last, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    b = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ b)
        b -= step
        if np.abs(step).max() < 1e-8:
            break
    return b


def scored(docs: DataFrame, labels: DataFrame, column: str = "toxic") -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (score >= 0.5).

    Null and empty texts have no hits and get the score of a document without
    any.  Without labels of both kinds everything scores 0.  Repeated rows are
    scored alike; an empty table gives an empty result.
    """
    known = F.broadcast(written(training_labels(labels, column, LABELLED), "labelled"))
    counts = {r["y"]: r["n"] for r in known.groupBy((F.col("y") > 0).alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = counts.get(True, 0), counts.get(False, 0)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if not n_pos or not n_neg:
        return texts.select("doc_id", held_out().alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    words = written(word_counts(texts.join(known, "doc_id")), "words")
    terms, weights, edited = learn_lexicon(words, n_pos, n_neg)
    rows = written(features(texts, terms, weights, edited), "features")
    fit = rows.join(known, "doc_id").select(*FEATURES, "y").toPandas()
    b = fit_logistic(fit[FEATURES].to_numpy(), (fit["y"] > 0).to_numpy().astype(float)) if len(fit) else np.zeros(len(FEATURES) + 1)
    z = sum((F.col(f) * float(c) for f, c in zip(FEATURES, b)), F.lit(float(b[-1])))
    score = 1 / (1 + F.exp(-z))
    return rows.select("doc_id", held_out().alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with their own columns."""
    bad = scored(docs, labels).where("predicted = 1").select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_id"]), "left_anti")
