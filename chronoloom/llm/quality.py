"""Quality scores by pairwise ranking.

A document's worth is a weighted sum of simple measures of its text.  The
weights maximise the Bradley-Terry likelihood of preference pairs, in each of
which a document labelled good is preferred to one labelled bad: logistic loss
on the difference of their measures.  The cut between good and bad is the
quantile of the scores at the share of bad documents among the labelled ones; a
logistic curve puts it at CUT.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chronoloom.llm.common import held_out, slices, training_labels, written

#: Labelled rows and pairs to learn from: bounds of what the driver sees.
LABELLED, PAIRS = 200_000, 400_000
CUT = 0.3
SYMBOLS = b"!#$%&*+<=>@[\\]^_`{|}~"
MEASURES = ["m_words", "m_distinct", "m_pairs", "m_top", "m_again", "m_caps", "m_symbols", "m_digits", "m_marks", "m_length", "m_lines",
            "m_line_words", "m_odd", "m_short"]
MEASURED = "doc_id long, " + ", ".join(f"{m} double" for m in MEASURES)


def measures(text: str | None) -> list[float]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(MEASURES)
    counts = Counter(words)
    follow = len(set(zip(words, words[1:]))) if n > 1 else 1
    lines = [x for x in (text or "").split("\n") if x.strip()]
    letters = max(sum(map(len, words)), 1)
    share = lambda drop: (len(raw) - len(raw.translate(None, drop))) / letters
    long_ = sum(1 for w in words if len(w) > 24)
    return [math.log1p(n), len(counts) / n, follow / max(n - 1, 1), max(counts.values()) / n, sum(map(eq, words, words[1:])) / n,
            sum(map(bytes.isupper, words)) / n, share(SYMBOLS), share(b"0123456789"), share(b".,;:?"), letters / n,
            len(set(lines)) / max(len(lines), 1), math.log1p(n / max(len(lines), 1)), long_ / n,
            sum(1 for w in words if len(w) < 3) / n]


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts, "text"):
            m = np.array([measures(t) for t in part.column("text").to_pylist()], float).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(m[:, j]) for j in range(len(MEASURES))]], ["doc_id", *MEASURES])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(batches, MEASURED)


def widened(x: np.ndarray) -> np.ndarray:
    """The measures and their squares."""
    return np.column_stack([x, x * x])


def fit_pairs(good: np.ndarray, bad: np.ndarray, pairs: int = PAIRS, ridge: float = 1.0, seed: int = 1) -> np.ndarray:
    """Bradley-Terry weights from pairs (good, bad) by Newton steps on the logistic loss of differences."""
    rng = np.random.default_rng(seed)
    n = min(pairs, 20 * max(len(good), len(bad)))
    d = good[rng.integers(len(good), size=n)] - bad[rng.integers(len(bad), size=n)]
    b = np.zeros(d.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(np.clip(d @ b, -30, 30)))  # chance given to the wrong order
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + ridge * np.eye(len(b)), d.T @ p - ridge * b)
        b += step
        if np.abs(step).max() < 1e-7:
            break
    return b


def scored(docs: DataFrame, labels: DataFrame, column: str = "quality") -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (score >= CUT).

    Null and empty texts have all measures 0 and are scored like any other.
    Without labels of both kinds everything scores 1.  Repeated rows are scored
    alike; an empty table gives an empty result.
    """
    known = F.broadcast(written(training_labels(labels, column, LABELLED), "labelled"))
    rows = written(measured(docs), "measures")
    # in order, so that the pairs drawn do not depend on how Spark returns the rows
    fit = rows.join(known, "doc_id").select("doc_id", *MEASURES, "y").toPandas().sort_values(["doc_id", *MEASURES])
    x, y = fit[MEASURES].to_numpy(), (fit["y"] > 0).to_numpy()
    if not y.any() or y.all():
        return rows.select("doc_id", held_out().alias("held_out"), F.lit(1.0).alias("score"), F.lit(1).alias("predicted"))
    x = widened(x)
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = (x - mean) / spread
    b = fit_pairs(z[y], z[~y])
    worth = z @ b
    cut = float(np.quantile(worth, 1 - y.mean()))
    scale = 4.0 / max(float(np.std(worth)), 1e-9)
    rank = F.lit(0.0)
    k = len(MEASURES)
    for j, m in enumerate(MEASURES):
        for value, at in ((F.col(m), j), (F.col(m) * F.col(m), j + k)):
            rank = rank + (value - float(mean[at])) * float(b[at] / spread[at])
    score = 1 / (1 + F.exp(-((rank - cut) * scale + math.log(CUT / (1 - CUT)))))
    return rows.select("doc_id", held_out().alias("held_out"), score.alias("score"), (score >= CUT).cast("int").alias("predicted"), rank.alias("rank"))
