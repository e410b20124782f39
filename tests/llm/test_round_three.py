"""Clustering, prefix trie and rank array against plain versions."""
import hashlib
import math
import random
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers as vocabularies
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_text import fuzz
from tokenizers import Tokenizer

from chronoloom.llm import prefix_trie, ptolemaic, rank_array

WORDS = vocabularies.path("word_bpe_49k.json")


def lloyd(rows, k, rounds, dim):
    """[(id, cluster, distance)] with Python integers."""
    kept = [(i, [math.floor(1024 * Fraction(c)) for c in v]) for i, v in rows
            if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [list(v) for _, v in start[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    near = lambda v: min((far(v, c), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in set(own):
            part = [v for (_, v), o in zip(kept, own) if o == j]
            centres[j] = [sum(c) // len(part) for c in zip(*part)]
    return [(i, near(v)[1], near(v)[0]) for i, v in kept], centres


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for name in ("id", "x", "far", "cluster", "distance"):
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(4)


@pytest.mark.parametrize("size", [1.0, 1e7, 3e30])
def test_clusters_equal_plain_rounds(spark, size):
    rnd = np.random.default_rng(3)
    rows = [(i, [float(np.float32(c)) for c in rnd.normal(rnd.integers(0, 4) * 3, 1, 4) * (size if i % 3 else 1.0)]) for i in range(-20, 200)]
    rows += [(7, rows[3][1]), (7, rows[3][1]), (None, rows[5][1]), (300, None), (301, [1.0, None, 2.0, 3.0]), (302, [1.0, float("nan"), 2.0, 3.0]),
             (303, [1.0, float("inf"), 2.0, 3.0]), (304, [1.0]), (305, [])]
    want, centres = lloyd(rows, 5, 6, 4)
    got = ptolemaic.clusters(vectors(spark, rows), 5, 6, 4).collect()
    cut = ptolemaic.LONGEST
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in got) == sorted((str(i), c, min(d, cut)) for i, c, d in want)
    names = {c: hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for c, v in enumerate(centres)}
    assert all(r.centroid_sha256 == names[r.cluster] for r in got)
    if size == 1.0:
        assert all(r.inertia == sum(d for _, _, d in want) and r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster) for r in got)


def test_clusters_edges(spark):
    assert ptolemaic.clusters(vectors(spark, []), 8, 2, 2).collect() == []
    same = ptolemaic.clusters(vectors(spark, [(i, [1.0, 2.0]) for i in range(5)]), 8, 3, 2).collect()
    assert {(r.cluster, r.distance, r.inertia) for r in same} == {(0, 0, 0)}  # ties: the smallest number
    assert [r.distance for r in ptolemaic.clusters(vectors(spark, [(1, [1.0, 2.0])]), 8, 3, 2).collect()] == [0]
    assert len(ptolemaic.clusters(vectors(spark, [(None, [1.0, 2.0]), (None, [3.0, 4.0])]), 8, 3, 2).collect()) == 2


def test_bounds_hold_and_spare_work():
    rnd = np.random.default_rng(1)
    for scale, limit in ((1, 1.0), (1000, 1.0), (10**6, 0.75)):
        centres = (rnd.normal(0, 1, (8, 64)) * scale * 3).astype(np.int64)
        v = (centres[rnd.integers(0, 8, 400)] + rnd.normal(0, .3, (400, 64)) * scale).astype(np.int64)
        v[:8] = centres  # a vector on a pivot
        own = ptolemaic.Round(centres + rnd.integers(-scale, scale + 1, centres.shape) // 9, centres)
        far = ptolemaic.table_of(v, centres)
        exact = np.stack([ptolemaic.squared(v, c[None]) for c in own.centres], axis=1)
        low = own.bounds(far)
        assert all(Fraction(b) ** 2 <= d for b, d in zip(low.ravel().tolist(), exact.ravel().tolist()))
        best, near, measured = own.assign(v, far)
        assert (best == exact.argmin(axis=1)).all() and (near == exact.min(axis=1)).all()
        assert measured <= limit * exact.size


def plain_trie(rows):
    turns = {}
    for c, t, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append(((t is not None, t or 0), role or "", text or ""))
    turns = {c: [x[1:] for x in sorted(v)] for c, v in turns.items()}
    made = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = turns.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:]
    nodes = {}
    for c, v in made.items():
        for d in range(len(v) + 1):
            nodes.setdefault(tuple(v[:d]), []).append(c)
    worth = {k: (len(m) - 1) * len(k[-1][1].encode()) if k else 0 for k, m in nodes.items()}
    kids, saved, leaves = {}, {}, {}
    for k in nodes:
        if k:
            kids[k[:-1]] = kids.get(k[:-1], 0) + 1
    for k in nodes:
        for d in range(len(k) + 1):
            saved[k[:d]] = saved.get(k[:d], 0) + worth[k]
            leaves[k[:d]] = leaves.get(k[:d], 0) + (k not in kids)
    ends = lambda k: ",".join(str(c) for c in sorted(nodes[k]) if len(made[c]) == len(k))
    return sorted((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), kids.get(k, 0), leaves[k], saved[k],
                   hashlib.sha256(ends(k).encode()).hexdigest()) for k, m in nodes.items())


def trie_rows(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("place", "depth", "a", "b", "bytes", "weight", "first", "_file", "leaf"):
        df = df.withColumn(name, F.lit("clash"))
    got = prefix_trie.trie(df.repartition(5)).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("block", [3, 65_536])
def test_trie_equals_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    rnd = random.Random(4)
    rows = []
    for c in [*range(-12, 60), 10**12]:
        for t in range(rnd.randint(1, 11)):
            rows.append((c, rnd.choice([t, t, t, None]) if rnd.random() < .2 else t, rnd.choice(["user", "user", None, ""]),
                         rnd.choice(["a", "a", "a", "é" * 3, None, ""])))
    rows += [(61, 0, "user", "x")] * 3 + [(c, t, "user", "same") for c in range(100, 130) for t in range(4)]  # repeated rows, copies
    rows += [(70, t, "user", str(t % 3)) for t in range(60)] + [(None, 0, "user", "lost"), (80, 1, "user", "long " * 50_000)]
    assert trie_rows(spark, rows) == plain_trie(rows)


def test_trie_edges(spark):
    assert trie_rows(spark, []) == [] and trie_rows(spark, [(None, 1, "user", "x")]) == []
    for rows in ([(1, 0, None, None)], [(2, None, "u", "x"), (2, None, "u", "x")], [(c, 0, "u", "x") for c in range(30)]):
        assert trie_rows(spark, rows) == plain_trie(rows)


def test_rank_array_equals_library(docs, monkeypatch):
    library = Tokenizer.from_file(WORDS)
    texts = fuzz(300) + ["The END, it's Éléments ÇÀ ÿß Øre naïve. été ½ x²", "!'s", "''s #'t a'S 'S", "<|startoftext|><|endoftext|>x<|ENDOFTEXT|>",
                         "x" * 700 + " " + "漢字" * 300]
    for held, short in ((300_000, 256), (20, 3)):
        monkeypatch.setattr(rank_array, "REMEMBERED", held)
        monkeypatch.setattr(rank_array, "SHORT", short)
        enc = rank_array.WordEncoder(WORDS)
        for a in range(0, len(texts), 40):
            part = [t or "" for t in texts[a:a + 40]]
            ids, ends = enc.encode(pa.array(part))
            shown, at = enc.decode(ids)
            at = np.append(0, at)
            for t, i, j in zip(part, [0, *ends[:-1]], ends):
                want = library.encode(t, add_special_tokens=False).ids
                assert ids[i:j].tolist() == want
                assert shown[at[i]:at[j]][:-1].decode() == library.decode(want, skip_special_tokens=False)
    rows = rank_array.encoded(docs([(i, t, "s") for i, t in enumerate(texts)] + [(None, "a b", "s"), (1, "x", "s"), (1, "x", "s")]), WORDS, with_ids=True).collect()
    assert len(rows) == len(texts) + 3
    for r in rows:
        assert r.n_tokens == len(r.ids) and r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False) and r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()


def test_rank_array_long_texts_and_empty_tables(spark, docs):
    library = Tokenizer.from_file(WORDS)
    rnd = random.Random(6)
    long = " \t ".join("".join(rnd.choice("aeinrstßé,'") for _ in range(rnd.randint(1, 12))) for _ in range(800_000))
    assert len(long) > 2 * rank_array.SLICE
    got = rank_array.encoded(docs([(1, long, "s")]), WORDS).collect()[0]
    want = library.encode(long, add_special_tokens=False).ids
    assert (got.n_tokens, got.ids_sha256) == (len(want), hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest())
    assert got.decoded_sha256 == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()
    assert rank_array.encoded(docs([]), WORDS).collect() == []
