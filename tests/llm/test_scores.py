import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoloom.llm import mixing, quality, topk, toxicity
from chronoloom.llm.common import held_out

WORDS = "river stone garden window letter morning silver quiet travel number simple market".split()


def corpus(rnd, n=600):
    rows, labels = [], []
    for i in range(n):
        ws = [rnd.choice(WORDS) + rnd.choice(["", "s", "ed", ",", "."]) for _ in range(rnd.randint(5, 80))]
        toxic = rnd.random() < 0.2
        if toxic:
            for _ in range(rnd.randint(1, 3)):
                ws.insert(rnd.randrange(len(ws) + 1), rnd.choice(["grobnik", "Zlurpen", "FRAGGLET!"]))
        good = rnd.random() < 0.8
        if not good:
            ws = [ws[0]] * 30 + [w.upper() + "!!" for w in ws]
        rows.append((i, " ".join(ws), "a"))
        labels.append((i, int(good), int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def labelled(spark):
    rows, labels = corpus(random.Random(1))
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {i: (q, t) for i, q, t in labels}


@pytest.mark.parametrize("what,which", [(toxicity, 1), (quality, 0)])
def test_held_out_accuracy(docs, labelled, what, which):
    rows, labels, truth = labelled
    got = what.scored(docs(rows), labels).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    right = sum(r.predicted == truth[r.doc_id][which] for r in held)
    assert right >= 0.95 * len(held) and all(0 <= r.score <= 1 for r in got)


@pytest.mark.parametrize("what", [toxicity, quality])
def test_labels_of_held_out_rows_do_not_matter(docs, labelled, what):
    rows, labels, _ = labelled
    turned = labels.withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic"))).withColumn(
        "quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in what.scored(docs(rows), x).collect()} for x in (labels, turned))
    assert a.keys() == b.keys() and max(abs(a[i] - b[i]) for i in a) < 1e-9


@pytest.mark.parametrize("what", [toxicity, quality])
def test_score_edges(docs, labelled, spark, what):
    rows, labels, _ = labelled
    odd = [(10_000, None, "a"), (10_001, "", "a"), (10_002, "w " * 60_000, "a"), (10_003, "same", "a"), (10_003, "same", "a"), (None, "x", None)]
    got = what.scored(docs(rows + odd), labels).collect()
    assert len(got) == len(rows) + 6 and all(r.score is not None for r in got)
    assert what.scored(docs([]), labels).count() == 0
    none = what.scored(docs(rows[:3]), labels.limit(0)).collect()
    assert len(none) == 3


def test_clean_keeps_columns(docs, labelled):
    rows, labels, truth = labelled
    out = toxicity.clean(docs(rows), labels)
    assert out.columns == docs(["x"]).columns
    assert {r.doc_id for r in out.select("doc_id").collect()} == {i for i in truth if not truth[i][1]}


def edits(w):
    letters = "abcdefghijklmnopqrstuvwxyz"
    return ({w[:i] + w[i + 1:] for i in range(len(w))} | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
            | {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters})


def test_automaton_finds_every_edit():
    terms = ["grobnik", "zlurp", "zlurpen", "aaaaa"]
    lexicon = toxicity.Lexicon([t.encode() for t in terms])
    rnd = random.Random(3)
    words = {e for t in terms for e in edits(t)} | {"".join(rnd.choice("grobnikzlupea") for _ in range(rnd.randint(1, 9))) for _ in range(3000)}
    for w in words - set(terms):
        want = min((i for i, t in enumerate(terms) if w in edits(t)), default=None)
        assert lexicon.misspelt(w.encode()) == want, w


def test_quotation():
    words = 'they said "you are a grobnik" and left'.encode().split()
    assert toxicity._quoted(words, words.index(b'grobnik"'))
    assert not toxicity._quoted(b'"quiet" you grobnik there'.split(), 2)


def test_pairs_learn_the_order():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = x @ np.array([2.0, -1.0, 0.0]) > 0
    b = quality.fit_pairs(x[y], x[~y])
    assert b[0] > 0 > b[1] and abs(b[2]) < abs(b[1])


def test_topk_against_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(150, 6)).astype(np.float32)
    base[50:110] = base[50]  # many equal vectors: ties
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    rows += [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (202, [float("nan")] * 6), (203, [float("inf")] + [0.0] * 5), (220, [1.0, 2.0]), (240, []), (None, [0.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash")).repartition(5)
    got = {}
    for r in topk.top_k(df, F.col("id") % 20 == 0, k=7).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    q = np.floor(64 * base.astype(float)).astype(int)
    want = {}
    for i in range(0, 150, 20):
        order = sorted((-int(q[i] @ q[j]), j) for j in range(150) if j != i)[:7]
        want[i] = [(n + 1, j, -s) for n, (s, j) in enumerate(order)]
    assert {i: sorted(v) for i, v in got.items()} == want


def test_topk_edges(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (20, [3.0])], "vec_id long, embedding array<float>")
    got = topk.top_k(df, F.col("id") % 20 == 0, k=20).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == [(0, 1, 20, 64 * 192), (0, 2, 1, 64 * 128), (20, 1, 1, 192 * 128), (20, 2, 0, 64 * 192)]
    assert topk.top_k(df.limit(0), F.col("id") % 20 == 0).count() == 0
    assert topk.top_k(df.where("vec_id = 1"), F.col("id") % 20 == 0).count() == 0
    wide = spark.createDataFrame([(0, [1e15, 1.0]), (1, [1e15, -1e15]), (1, [0.0, 0.0])], "vec_id long, embedding array<double>")
    assert topk.top_k(wide, F.col("id") % 20 == 0).count() == 2


def test_targets_and_mix(docs):
    rnd = random.Random(7)
    rows, sizes = [], Counter()
    for i in range(900):
        source = rnd.choice(["s0", "s0", "s0", "s1", "é", "S2", None])
        n = min(3000, int(rnd.paretovariate(0.9)) * 5)
        rows.append((i, " ".join(["w"] * n), source))
        sizes[source] += n
    rows += [(5000, None, "s0"), (5001, "", None)]
    got = {r.doc_id: r for r in mixing.mix(docs(rows), bucket=50).collect()}
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: [1, 2, 3][i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), sum(sizes.values())
    while True:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 3.0 * sizes[s] for s in full}
        open_ -= full
        left = sum(sizes.values()) - sum(target.values())
    taken = Counter()
    for i, t, s in rows:
        r, n = got[i], len((t or "").split())
        assert r["size"] == n and r.source_size == sizes[s] and abs(r.target - target[s]) < 1e-6 * max(1, target[s])
        assert r.taken <= 3 * n and r.taken == r.copies * n
        whole = int(target[s] / sizes[s] + 1e-12)
        assert r.copies in (whole, whole + 1) or n == 0
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(20, 0.03 * target[s]), (s, taken[s], target[s])
    again = {r.doc_id: r.taken for r in mixing.mix(docs(rows).repartition(7), bucket=50).collect()}
    assert again == {i: r.taken for i, r in got.items()}


def test_a_long_document_does_not_end_its_source(docs):
    """A document longer than what its source lacks fills its bucket; the buckets behind go on filling the source."""
    rows = [(i, "w " * 40, "a") for i in range(2499)] + [(5000, "w " * 100_000, "a")] + [(9000 + i, "w " * 20_000, "b") for i in range(4)]
    got = [r for r in mixing.mix(docs(rows), weights=(1.0, 1.916), bucket=100).collect() if r.doc_id < 9000]
    assert len(got) == 2500 and 90_000 < got[0].target < 100_000
    assert abs(sum(r.taken for r in got) - got[0].target) <= 40


def test_mix_edges(docs):
    assert mixing.mix(docs([])).count() == 0
    assert sum(r.taken for r in mixing.mix(docs([None, "", " "])).collect()) == 0
    rows = mixing.mix(docs([(1, "a b", None), (1, "a b", None), (2, "c", None)])).collect()
    assert len(rows) == 3 and sum(r.taken for r in rows) == 5
    out = mixing.repeated(docs([(1, "a b", "x"), (2, "c d e", "y"), (3, "f", "z")]))
    assert out.columns == docs(["x"]).columns


def test_bigger_odds_are_drawn_more_often(docs):
    """Over many seeds every document of a source is drawn about as often as its inclusion chance says."""
    df = docs([(i, "w w", "b" if i % 2 else "a") for i in range(40)])
    df = df.cache()
    drawn = Counter()
    for seed in range(12):
        for r in mixing.mix(df, weights=(1, 3), seed=seed).where("copies > 0").collect():
            drawn[r.doc_id] += r.copies
    a = [drawn[i] for i in range(0, 40, 2)]
    assert sum(a) == 12 * 10 and len(set(a)) > 1 and max(a) < 12


def test_inclusion_follows_size(docs):
    """Chances are in proportion to size, add up to the missing words, and are met over many sources."""
    rows = [(1000 * s + i, "w " * (30 if i < 30 else 10), f"s{s:03d}") for s in range(60) for i in range(90)]
    got = mixing.mix(docs(rows), bucket=20).toPandas()
    got["rate"] = (got.target / got.source_size).round(6)
    for rate, gap in ((0.5, 750), (1.5, 750), (1.0, 0)):
        part = got[got.rate == rate]
        extra = part.copies - int(rate)
        assert abs((part.chance * part["size"]).sum() - 20 * gap) < 1e-6 * 20 * 750 and extra.isin([0, 1]).all()
        long_, short = part["size"] == 30, part["size"] == 10
        if gap:
            assert abs(part.chance[long_].iloc[0] / part.chance[short].iloc[0] - 3) < 1e-9
            assert abs(extra[long_].mean() - part.chance[long_].iloc[0]) < 0.05 and abs(extra[short].mean() - part.chance[short].iloc[0]) < 0.04


def test_a_document_whose_chance_would_pass_one_is_certain(docs):
    """100 words in 1 document and 1 word in 300, half of them wanted: the long one always comes, the others fill the rest."""
    rows = [(i, "w", "a") for i in range(300)] + [(500, "w " * 100, "a"), (501, "w " * 400, "b")]
    for seed in (4,):
        got = {r.doc_id: r for r in mixing.mix(docs(rows), weights=(1, 3), seed=seed).collect()}
        assert got[500].chance == 1.0 and got[500].copies == 1
        assert abs(got[0].chance - 100 / 300) < 1e-9 and sum(r.taken for i, r in got.items() if i < 501) == 200
