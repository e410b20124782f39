import hashlib
import random
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers as vocabularies
import pytest
import tiktoken
from tokenizers import Tokenizer

from chronoloom.llm import merge_replay, page_text, token_files

ALPHABET = " \t\n\r\x0b\x0c\x1c\x85\xa0᠎ 　aaAbB'stremlldÅéΣσç̧İiI019漢字\U0001f642.,-_!?́<|>"


def fuzz(n=300):
    rnd = random.Random(1)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 40))) for _ in range(n)] + [
        None, "", "a" * 3000, "ab" * 2000, "it's we'll 's't're   'm  \n\n x", "x<|endoftext|>y <|startoftext|> A", "ΑΣ Σ."]


@pytest.fixture(scope="module")
def bpe():
    ranks = merge_replay.load_ranks(vocabularies.path("byte_bpe_multi_50k.tiktoken"))
    return ranks, tiktoken.Encoding("own", pat_str=vocabularies.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_replay_equals_library(docs, bpe):
    texts = fuzz()
    got = {r.doc_id: r for r in merge_replay.encoded(docs(texts), vocabularies.path("byte_bpe_multi_50k.tiktoken"), vocabularies.PATTERN,
                                                     with_ids=True).collect()}
    for i, t in enumerate(texts):
        want = bpe[1].encode_ordinary(t or "")
        assert got[i].ids == want and got[i].n_tokens == len(want)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_both_replays_agree_on_odd_ranks():
    """Ranks in random order: later merges may have lower ranks."""
    rnd = random.Random(5)
    for _ in range(30):
        tokens = {bytes([i]) for i in range(256)}
        for _ in range(60):
            tokens.add(rnd.choice(sorted(t for t in tokens if set(t) <= set(b"abc"))) + rnd.choice(sorted(t for t in tokens if set(t) <= set(b"abc"))))
        more = sorted(tokens - {bytes([i]) for i in range(256)})
        rnd.shuffle(more)
        ranks = {bytes([i]): i for i in range(256)} | {t: 256 + i for i, t in enumerate(more)}
        words = sorted({bytes(rnd.choice(b"abc") for _ in range(rnd.randint(0, 14))) for _ in range(200)})
        library = tiktoken.Encoding("own", pat_str="[abc]+", mergeable_ranks=ranks, special_tokens={})
        want = [library.encode_ordinary(w.decode()) for w in words]
        flat, ends = merge_replay.replay_many(words, ranks, merge_replay.PairTable(ranks))
        assert [flat[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)] == want
        assert merge_replay.replay(words, ranks) == want


def test_chunks_are_forgotten(bpe, monkeypatch):
    monkeypatch.setattr(merge_replay, "REMEMBERED", 5)
    enc = merge_replay.Encoder(bpe[0], vocabularies.PATTERN)
    for t in ["one two three four five six seven", "one two", "", "eight nine ten eleven"]:
        assert enc.encode([t])[0].tolist() == bpe[1].encode_ordinary(t)


def test_rare_runs_are_forgotten(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 40)
    name = vocabularies.path("word_bpe_49k.json")
    enc, library = token_files.ChunkEncoder(name), Tokenizer.from_file(name)
    for end in (None, 1):
        enc.forget()
        for i in range(0, 300, 7):
            texts = [t or "" for t in fuzz()[i:i + 7]] + ["The end. the END, it's Éléments ÇÀ ÿß Øre, naïve. été"]
            ids, ends = enc.encode(texts, end)
            tail = [] if end is None else [end]
            assert [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)] == [library.encode(t, add_special_tokens=False).ids + tail for t in texts]


def test_words_share_calls():
    """Latin words go to the model many at a time, never one by one; ids are the library's for any number of them."""
    name, rnd, one = vocabularies.path("word_bpe_49k.json"), random.Random(9), []
    enc, library = token_files.ChunkEncoder(name), Tokenizer.from_file(name)
    letters = "abcdefghijklmnopqrstuvwxyz" * 3 + "".join(chr(c) for c in range(0xc0, 0x100) if c not in (0xd7, 0xf7))
    words = list(dict.fromkeys("".join(rnd.choice(letters) for _ in range(rnd.randint(1, 14))) for _ in range(2_000)))
    full = enc.tokenizer
    enc.tokenizer = SimpleNamespace(encode_batch_fast=full.encode_batch_fast, model=SimpleNamespace(tokenize=lambda w: one.append(w) or full.model.tokenize(w)))
    texts = [" ".join(words), "", "12 ;; 东京", *[" ".join(words[:n]) for n in (1, 255, 256, 257, 512)], "A" * 3_000 + " " + "é" * 3_000, "a<|endoftext|>b " + words[0]]
    for group in ([t] for t in texts):
        enc.forget()
        ids, ends = enc.encode(group, 1)
        assert ids.tolist() == library.encode(group[0], add_special_tokens=False).ids + [1] and ends.tolist() == [len(ids)]
    assert not one


def test_marks_share_the_word():
    """A word that is known is not encoded again for the marks behind it."""
    name, new = vocabularies.path("word_bpe_49k.json"), []
    enc, library = token_files.ChunkEncoder(name), Tokenizer.from_file(name)
    enc.encode(["house"])
    ids = enc._ids
    enc._ids = lambda words: new.extend(words.to_pylist()) or ids(words)
    text = "house, house. House$$$ house"
    assert enc.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    assert sorted(new) == ["$$$", ",", "."]


def test_words_without_an_end_mark():
    """A model that does not mark the last id of a word gets its words through all steps."""
    name = vocabularies.path("word_bpe_49k.json")
    enc, library = token_files.ChunkEncoder(name), Tokenizer.from_file(name)
    enc.last = None
    texts = ["one été two", "", "x, y"]
    ids, ends = enc.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_token_files(spark, docs):
    from chronoloom.llm.common import scratch_folder
    texts = fuzz()
    rnd = random.Random(2)
    ids = list(range(-5, len(texts) - 5))
    rnd.shuffle(ids)
    path, name = scratch_folder(spark, "tokens"), vocabularies.path("word_bpe_49k.json")
    got = {r.doc_id: r for r in token_files.tokenized(docs([(i, t, "s") for i, t in zip(ids, texts)]), name, path=path).collect()}
    library, start, every = Tokenizer.from_file(name), 0, []
    for i, t in sorted(zip(ids, texts)):
        own = library.encode(t or "", add_special_tokens=False).ids + [1]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        start += len(own)
        every += own
    span = token_files.read_span(spark, path, 100, 1500).orderBy("start").collect()
    assert [t for r in span for t in r.ids] == every[100:1500]
    plan = token_files.read_tokens(spark, path, "doc_id", "n_tokens").where("doc_id = 3")._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,3)" in plan and "ids" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_token_files_edges(docs):
    name = vocabularies.path("word_bpe_49k.json")
    assert token_files.tokenized(docs([]), name).count() == 0
    rows = token_files.tokenized(docs([(1, "a", "s"), (1, "a", "s"), (1, "b c", "s"), (None, "d", "s"), (None, None, "s")]), name).collect()
    assert sorted(r.start for r in rows) == [0, 1, 3, 5, 7] or len({r.start for r in rows}) == 5


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="site-header"><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></li></ul></nav>
<div id="cookie-notice">We use cookies, many, many cookies</div><div class="layout"><div class="sidebar"><p>Side, text, is, here, many, commas</p></div>
<div class="content"><h2>Ti&amp;tle</h2><p>First para, with <a href="#">a link</a> and text that is long enough to be scored.</p>
<p>Se<b>co</b>nd para &nbsp; here<br>next<div class="ad">Buy</div><ul><li>one<li>two, three</ul><form><input>Sign up</form><!-- gone --></div></div>
<section class="comments"><p>Nice post, really, I mean it, great, great stuff and more words than the article has, maybe, or not</p></section><footer>(c)</footer></body></html>"""


def test_main_text():
    assert page_text.main_text(PAGE) == ("Ti&tle First para, with a link and text that is long enough to be scored. Second para here next one two, three")
    assert page_text.main_text(None) == "" and page_text.main_text("") == "" and page_text.main_text("<p> </p>") == ""
    assert page_text.main_text("plain <b>te</b>xt") == "plain text"
    assert page_text.main_text("<article><h1>A</h1><p><b>open<br><p>b</p></article><div>" + "long, other text, " * 9 + "</div>") == "A open b"
    assert page_text.main_text("<div><p>x &lt; y</div>tail <script>if (a<b) {}</script>") == "x < y tail"
    assert page_text.main_text("<" * 2000 + "a \"" * 300) is not None
    assert page_text.main_text("<div>" * 3000 + "<p>deep</p>") == "deep"


LONG = "Words of the article, long enough, with commas, to be scored well. "


@pytest.mark.parametrize("page,want", [
    (f"<body><form id=aspnetForm><div class=menu><a href=x>Menu</a></div><div id=c><p>{LONG}</p><p>{LONG}</p></div></form></body>", [LONG, LONG]),
    (f"<div class='layout with-sidebar'><article><p>{LONG}</p></article><div class=sidebar><p>Side, text</p></div></div>", [LONG]),
    (f"<div class='no-sidebar'><div><p>{LONG}</p><p>{LONG}</p></div></div><div class=sidebar><p>Side, text</p></div>", [LONG, LONG]),
    (f"<main><article><p>{LONG * 3}</p></article><article><p>{LONG * 2}</p></article></main>", [LONG * 3, LONG * 2]),
    (f"<article><h1>Title</h1><div itemprop=articleBody><p>{LONG}</p><p>{LONG}</p></div></article>", ["Title", LONG, LONG]),
    (f"<div class=x><p>{LONG * 3}</p></div><aside><article><p>{LONG}</p></article></aside>", [LONG * 3]),
    (f"<div class=x><p>{LONG}</p></div><div class=comments><p>{LONG}</p><p>{LONG}</p></div>", [LONG]),
    (f"<article><header><h1>Title</h1></header><p>{LONG}</p></article><aside><p>Aside, text</p></aside>", [LONG]),
])
def test_wrapped_and_divided_articles(page, want):
    assert page_text.main_text(page) == " ".join(x.strip() for x in want)


def test_pages_table(spark):
    rows = [(1, "u", PAGE, "c"), (1, "u", PAGE, "c"), (2, None, None, "c"), (None, "v", "<p>" + "w " * 50_000, "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = page_text.extracted(df).collect()
    assert len(out) == 4 and all(r.n_chars == len(r.text) for r in out)
    assert page_text.extracted(df.limit(0)).count() == 0


def test_distinct_runs_stay_bounded(bpe):
    """A text of a million different runs, in one piece and cut over texts: right ids, and a small table."""
    import subprocess
    import sys
    code = """
import resource, sys
sys.path.insert(0, %r)
import numpy as np, public_tokenizers as v
from chronoloom.llm import merge_replay
enc = merge_replay.Encoder(merge_replay.load_ranks(v.path("byte_bpe_multi_50k.tiktoken")), v.PATTERN)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
rng = np.random.default_rng(1)
text = " ".join("".join(map(chr, w)) for w in rng.integers(97, 123, (1_300_000, 8)).tolist())
enc.encode([text[i:i + 100_000] for i in range(0, 3_000_000, 100_000)])
n = len(enc.encode([text])[0])
assert len(enc.chunks) <= merge_replay.REMEMBERED + merge_replay.FRESH
print(n, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    import os
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    n, more = map(int, subprocess.run([sys.executable, "-c", code % root], capture_output=True, text=True, check=True, timeout=300).stdout.split())
    rng = np.random.default_rng(1)
    text = " ".join("".join(map(chr, w)) for w in rng.integers(97, 123, (1_300_000, 8)).tolist())
    assert n == len(bpe[1].encode_ordinary(text))
    assert more < 600  # MB, the text's own million Python strings while it is made among them
