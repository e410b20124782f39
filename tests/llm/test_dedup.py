import hashlib
import random
import re
from types import SimpleNamespace

import ahocorasick
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chronoloom.llm import exact_dedup, minhash, phrases
from chronoloom.llm.components import components

WORDS = "alpha beta gamma delta Epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def sentence(rnd, n):
    return " ".join(rnd.choice(WORDS) + str(rnd.randint(0, 9)) for _ in range(n))


ODD = [None, "", " \t\n", "a", "a b c d", "A B c D", "a b c d e", "x " * 30, "é   z", "y" * 5000]


def normal(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(docs, weak):
    texts = [*ODD, "ab cd", "a b\tcd", "abcd ", None, "x" * 3, "x x x"]
    digest = (lambda c: F.substring(F.sha2(c, 256), 1, 1)) if weak else exact_dedup.sha  # weak: different texts share digests
    got = {r.doc_id: r for r in exact_dedup.dedup(docs(texts), digest=digest).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        group = [j for j, u in enumerate(texts) if normal(u) == normal(t)]
        keep = min(group, key=lambda j: (-len(texts[j] or ""), j))
        r = got[i]
        assert (r.keep_id, r.group_size, r.kept) == (keep, len(group), keep == i)
        assert r.text_sha256 == hashlib.sha256(normal(t).encode()).hexdigest()


def test_exact_state_goes_on(spark, docs):
    from chronoloom.llm.common import scratch_folder
    state = scratch_folder(spark, "state")
    prints = scratch_folder(spark, "prints")
    schema = exact_dedup.fingerprints(docs(["a"])).schema
    exact_dedup.fingerprints(docs(["one", "two"])).write.parquet(prints)
    exact_dedup.update_state(spark, prints, schema, state)
    exact_dedup.fingerprints(docs([(7, "o ne", "a")])).write.mode("append").parquet(prints)
    rows = {r.keep_id: r.group_size for r in exact_dedup.update_state(spark, prints, schema, state).collect()}
    assert rows == {7: 2, 1: 1}


def test_exact_edges(docs):
    assert exact_dedup.dedup(docs([])).count() == 0
    repeated = docs([(1, "a", "s"), (1, "a", "s"), (None, "b", "s"), (None, "c", "s"), (2, "b", "s")])
    assert exact_dedup.dedup(repeated).count() == 5
    assert sorted(str(r.doc_id) for r in exact_dedup.unique_rows(repeated).collect()) == ["1", "None", "None"]
    out = exact_dedup.unique_rows(docs(["a b", "ab", "c"]))
    assert sorted(r.doc_id for r in out.collect()) == [0, 2] and out.columns == docs(["x"]).columns


def shingles(t):
    ws = [w.lower() if w.isascii() else w for w in (t or "").encode().lower().decode().split()]
    return {tuple(ws)} if 0 < len(ws) < 5 else {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)}


def brute_components(ids, sets):
    comp = {i: i for i in ids}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                p, q = root(i), root(j)
                comp[max(p, q)] = min(p, q)
    return {i: root(i) for i in ids}


def near_texts():
    rnd = random.Random(4)
    texts = list(ODD)
    base = sentence(rnd, 120).split()
    texts.append(" ".join(base))
    for _ in range(60):  # a group in which many pairs lie near the limit
        own = list(base)
        for _ in range(rnd.randint(1, 5)):
            own[rnd.randrange(120)] = "changed" + str(rnd.randint(0, 99))
        texts.append(" ".join(own))
    chain = sentence(rnd, 60).split()
    for step in range(12):  # each like the next only
        texts.append(" ".join(chain[step * 2:] + [f"tail{k}" for k in range(step * 2)]))
    return texts + [sentence(rnd, rnd.randint(5, 80)) for _ in range(30)] + texts[10:14]


def test_near_against_brute_force(docs):
    texts = near_texts()
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    want = brute_components(list(range(len(texts))), sets)
    got = {r.doc_id: r for r in minhash.near_duplicates(docs(texts)).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(got[i].n_shingles == len(sets[i]) and got[i].kept == (want[i] == i) for i in sets)


def test_near_without_random_centres(docs, monkeypatch):
    """The exhaustive rest alone must find every link that the first round leaves."""
    monkeypatch.setattr(minhash, "TURNS", 0)
    texts = near_texts()
    want = brute_components(list(range(len(texts))), {i: shingles(t) for i, t in enumerate(texts)})
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs(texts)).collect()} == want


def test_near_edges(docs):
    assert minhash.near_duplicates(docs([])).count() == 0
    rows = minhash.near_duplicates(docs([None, "", None])).collect()
    assert all(r.n_shingles == 0 and r.component_id == r.doc_id and r.kept for r in rows)
    assert minhash.near_duplicates(docs([(1, "a b", "s"), (1, "a b", "s"), (None, "q r", "s")])).count() == 3
    out = minhash.one_of_each(docs(["a b c", "A b C", "d"]))
    assert sorted(r.doc_id for r in out.collect()) == [0, 2] and out.columns == docs(["x"]).columns


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(1)
    tables = []
    for n in (1, 3, 50, 5000):
        s = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        t = minhash.sketches([s, s[:max(1, int(n * 0.8))]])
        assert (t != minhash.FULL).all()
        tables.append((t[0] == t[1]).mean())
    assert abs(tables[3] - 0.8) < 0.15


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    comp = {}

    def root(i):
        comp.setdefault(i, i)
        while comp[i] != i:
            i = comp[i]
        return i
    for a, b in edges:
        if a != b:
            p, q = root(a), root(b)
            comp[max(p, q)] = min(p, q)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: root(i) for i in comp}


def brute_passages(rows):
    seen, removed = set(), {}
    for key, (i, t) in sorted(enumerate(rows), key=lambda x: (x[1][0], x[0])):
        ws = (t or "").encode().split()
        gone = set()
        for p in range(len(ws) - 19):
            w = tuple(ws[p:p + 20])
            if w in seen:
                gone |= set(range(p, p + 20))
            seen.add(w)
        removed[key] = (i, len(ws), len(gone), hashlib.sha256(b" ".join(w for p, w in enumerate(ws) if p not in gone)).hexdigest())
    return sorted(removed.values())


@pytest.mark.parametrize("hot,shard", [(200, 40_000), (3, 10), (0, 40_000)])
def test_passages_against_brute_force(docs, monkeypatch, hot, shard):
    monkeypatch.setattr(phrases, "SHARD", shard)
    rnd = random.Random(3)
    line, long_ = sentence(rnd, 25), sentence(rnd, 90)
    texts = [*ODD, "na " * 100, "is it " * 60]
    for k in range(40):
        parts = [sentence(rnd, rnd.randint(0, 40))]
        for _ in range(rnd.randint(0, 3)):
            cut = rnd.randint(0, 60)
            parts += [rnd.choice([line, long_, " ".join(long_.split()[cut:cut + 30])]), sentence(rnd, rnd.randint(0, 30))]
        texts.append(rnd.choice([" ", "\n", "\t "]).join(parts))
    texts += texts[12:16] + [texts[13].replace(" ", "\n")]
    order = list(range(len(texts)))
    rnd.shuffle(order)
    rows = list(zip(order, texts))
    got = phrases.repeated_passages(docs([(i, t, "s") for i, t in rows]), hot=hot, with_text=True).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_passages(rows)
    for r in got:
        if r.kept_text is not None:
            assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256


def test_passages_work_once(monkeypatch):
    """A piece that stands in many places is one pattern and is streamed once."""
    done = []

    class Counting:
        def __init__(self, *args):
            self.real = ahocorasick.Automaton(*args)

        def add_word(self, words, value):
            done.append(len(words))
            return self.real.add_word(words, value)

        def make_automaton(self):
            return self.real.make_automaton()

        def iter(self, words):
            done.append(len(words))
            return self.real.iter(words)

    monkeypatch.setattr(phrases, "ahocorasick", SimpleNamespace(Automaton=Counting, STORE_INTS=ahocorasick.STORE_INTS, STORE_ANY=ahocorasick.STORE_ANY,
                                                                KEY_SEQUENCE=ahocorasick.KEY_SEQUENCE))
    words = [b"w%d" % i for i in range(50)]
    rows = [(7, i, bytes(16), 3, b" ".join(words[:40])) for i in range(100)] + [(7, 100, bytes(16), 0, b" ".join(words[10:40]))]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["key", "doc_id", "digest", "start", "words"])
    gone = {}
    for part in phrases._locate_batches(iter([batch])):
        for r in part.to_pylist():
            gone.setdefault(r["doc_id"], set()).update(range(r["start"], r["stop"]))
    assert gone == {i: set(range(3, 43)) for i in range(1, 100)} | {100: set(range(30))}
    assert sum(done) <= 40 + 11 * 20 + 40 + 30  # one whole piece, the windows both pieces share, two streams


def test_words_by_arrow():
    texts = [None, "", " \n", " a  b\x0bc\x1c\x85d ", "é\u3000ü x" + "y" * 70, "x" + "y" * 70 + " a", "aaaaaaaa aaaaaaaaa a\0 a"]
    split = [(t or "").encode().split() for t in texts]
    for k in (0, 3):  # a slice, too
        words = phrases.Words(pa.array(texts, pa.string()).slice(k))
        assert words.texts() == [b" ".join(w) for w in split[k:]]
        assert (words.ends - words.starts).tolist() == [len(w) for w in split[k:]]
        flat = [w for ws in split[k:] for w in ws]
        pairs = set(zip(flat, words.hashes().tolist()))
        assert len(pairs) == len(set(flat)) == len({h for _, h in pairs})


def test_passages_edges(docs):
    assert phrases.repeated_passages(docs([])).count() == 0
    t = " ".join(map(str, range(30)))
    got = phrases.repeated_passages(docs([(1, t, "s"), (1, t, "s"), (1, t + " x", "s"), (None, t, "s"), (None, None, "s")])).collect()
    assert len(got) == 5 and all(r.n_removed <= r.n_words for r in got)
