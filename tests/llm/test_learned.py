"""Pieces, pages, toxicity and the pipeline."""

from __future__ import annotations

import html
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from rollbook.llm import pieces, queries, toxicity, web_pages
from rollbook.llm.common import table
from tests.llm.conftest import SF

STRANGE = ["", " ", "  x  y ", "▁", "a▁ ▁b", "\n\t\r\x00", "日本語 😀 é", "x" * 3000, " " * 70, "a" * 65 + "▁" + " b" * 40, "﻿é"]


@pytest.fixture(scope="module")
def words():
    return pieces.Vocabulary(*pieces.read_model(pieces.MODEL))


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.9, 1.0])
def test_pieces_round_trip(words, rate):
    work = pieces.Segmenter(words, rate, 3, 4)
    for text, ids in zip(STRANGE, work.encode(STRANGE, range(len(STRANGE))), strict=True):
        assert work.decode(ids) == text


def test_pieces_without_dropout_equal_the_library(words):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    draw = random.Random(2)
    texts = ["".join(draw.choices("abcdefghij é ß,.  \n", k=80)) for _ in range(200)] + [t for t in STRANGE if "▁" not in t and "\x00" not in t]
    got = pieces.Segmenter(words, 0.0, 1, 1).encode(texts, [1] * len(texts))
    assert [g.tolist() for g in got] == [model.encode(t) for t in texts]


def test_both_ways_to_work_off_an_agenda_agree(words):
    work = pieces.Segmenter(words, 0.3, 5, 2)
    draw = random.Random(3)
    chunks = [" " * draw.randint(0, 3) + "".join(draw.choices("etaoinshré日▁", k=draw.randint(1, 30))) for _ in range(300)]
    draws = [draw.randrange(2) for _ in chunks]
    assert work.segment(chunks, draws) == [work.segment_long(c, d) for c, d in zip(chunks, draws, strict=True)]


def test_encode_and_decode_tables(spark, docs):
    rows = [(i, t) for i, t in enumerate(STRANGE)] + [(50, None), (None, "no id"), (60, "twice the same words here"), (60, "twice the same words here")]
    given = docs(rows)
    encoded = pieces.encode(given.coalesce(1), rate=0.5)
    found = encoded.collect()
    assert all(r.lossless for r in found) and len(found) == len(rows) and all(r.n_pieces == len(r.ids) for r in found)
    same = [r.ids for r in found if r.doc_id == 60]
    assert same[0] != same[1]
    assert [tuple(r.ids) for r in pieces.encode(given.coalesce(1), rate=0.5).collect()] == [tuple(r.ids) for r in found]
    texts = {r.doc_id: r.text for r in pieces.decode(encoded).collect()}
    assert all(texts[i] == t for i, t in enumerate(STRANGE)) and texts[50] == ""
    assert pieces.encode(docs([])).count() == 0


def _page(body: str) -> str:
    return f"<html><head><title>t</title><style>p{{}}</style></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""),
        ("just text &amp; more", "just text & more"),
        (_page("<nav><a>Home</a></nav><article><h1>T</h1><p>One<br>two <b>th</b>ree<p>Four</article><footer>f</footer>"), "T One two three Four"),
        (_page("<div class='ad'>buy</div><main><p>a&nbsp;b\n c</p><form>x<input></form></main>"), "a b c"),
        (_page("<article><header><h1>T</h1></header><p>x</p><aside>no</aside><div class=comments><p>me too</p></div></article>"), "T x"),
        (_page("<header>Site</header><div id=sidebar>s</div><p>open <script>var a='</p>';</script>text</p><p hidden>y"), "open text y"),
        (_page("<div class='cookie-notice'>ok?</div><article><p>1 < 2 &lt;b&gt; <!-- c --> z</p>"), "1 < 2 <b> z"),
        (_page("<nav><ul><li>never closed<article><p>kept</p></article>"), "kept"),
        (_page("<article><p>a</p><article class='comment'><p>b</p></article><p>c</p></article><article><p>d</p></article>"), "a c d"),
        (_page("<article><p title='a>b'>q</p><p class=\"ad\">buy<p>r</article>"), "q r"),
    ],
)
def test_blocks_of_a_page(page, text):
    assert " ".join(t for z, t in web_pages.blocks(page) if z != web_pages.CHROME) == text


def test_suffix_runs_equal_brute_force():
    draw = random.Random(5)
    pages = [draw.choices("abc", k=draw.randint(0, 40)) for _ in range(12)]
    at, low, high = web_pages.suffix_runs(pages, list(range(12)), 3)
    want: dict[tuple, set] = {}
    for p, tokens in enumerate(pages):
        for i in range(len(tokens) - 2):
            want.setdefault(tuple(tokens[i : i + 3]), set()).add(p)
    whole = [t for tokens in pages for t in [*tokens, None]]
    got = {tuple(whole[a : a + 3]): (x, y) for a, x, y in zip(at, low, high, strict=True)}
    assert got == {k: (min(v), max(v)) for k, v in want.items()}


@pytest.mark.parametrize("slice_bytes", [1 << 22, 300])
def test_repeated_text_of_a_host_goes_and_unique_runs_stay(spark, slice_bytes):
    notice = "we use small files on your machine to remember what you like best of all"
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(12))
    pages = [(i, "http://a.example/p", f"<div>{notice}</div><div>{own(i)}</div><div>short</div>") for i in range(20)]
    pages += [(100 + i, "http://b.example/", f"<div>{notice}</div>") for i in range(2)]  # copies of one page
    pages += [(200, None, "<p>x y</p>"), (201, "http://a.example/", None), (None, "http://a.example/", f"<article>{notice}</article>")]
    given = spark.createDataFrame([(*p, "x", "x") for p in pages], "page_id long, url string, html string, host string, row string")
    got = {r.page_id: r.text for r in web_pages.extract(given, slice_bytes=slice_bytes).collect()}
    assert len(got) == len(pages)
    for i in range(20):
        assert got[i] in (own(i), f"{own(i)} short"), got[i]
    assert got[100] == notice and got[200] == "x y" and got[201] == "" and got[None] == notice
    assert web_pages.extract(given.limit(0)).count() == 0


def test_main_text_of_the_table(spark):
    pages = {r.page_id: r.html for r in table(spark, SF, "pages").collect()}
    for r in queries.op5_main_text(spark, SF).collect():
        inner = re.search("<article>(.*)</article>", pages[r.page_id], re.S).group(1)
        flat = re.sub("</?(?:p|h1|br)>", " ", re.sub("</?b>", "", inner))
        assert r.text == " ".join(html.unescape(flat).split()) and r.n_chars == len(r.text)


def _rated(n: int = 600) -> list[tuple]:
    draw = random.Random(8)
    syllables = "an er on re he in ed nd ha at en".split()
    word = lambda: "".join(draw.choices(syllables, k=draw.randint(1, 4)))
    rows = []
    for i in range(n):
        text = [word() for _ in range(40)]
        if toxic := i % 5 == 0:
            for _ in range(2):
                text[draw.randrange(40)] = draw.choice(("idiot", "scum", "worthless", "zorbl" + word()))
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_toxicity_is_learned_from_labels_and_kept_from_the_held_out(docs, labels):
    rows = _rated()
    given = [(i, t) for i, t, _ in rows] + [(9000, None), (9001, ""), (None, "you are a worthless idiot"), (9002, rows[1][1]), (9002, rows[1][1])]
    own = labels([(i, 1, y) for i, _, y in rows] + [(3, 1, None), (None, 1, 1)])
    got = toxicity.rate(docs(given), own).collect()
    assert len(got) == len(given) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    truth = {i: y for i, _, y in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 60 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    other = {r.doc_id: r for r in got if r.doc_id not in truth}
    assert other[9000].predicted == 0 and other[9001].predicted == 0 and other[None].predicted == 1
    flipped = labels([(r[0], 1, 1 - r[2] if any(g.doc_id == r[0] and g.held_out for g in got) else r[2]) for r in rows])
    again = {r.doc_id: r.score for r in toxicity.rate(docs(given), flipped).collect()}
    assert again == {r.doc_id: r.score for r in got}


def test_toxicity_without_labels_or_rows(docs, labels):
    got = {r.doc_id: r.predicted for r in toxicity.rate(docs([(1, "you pathetic moron"), (2, "a fine day")]), labels([])).collect()}
    assert got == {1: 1, 2: 0}
    assert toxicity.rate(docs([]), labels([(1, 1, 1)])).count() == 0


def test_label_model_sees_accuracies_and_correlations():
    draw = np.random.default_rng(0)
    truth = draw.random(6000) < 0.3
    vote = lambda right: np.where(draw.random(6000) < right, np.where(truth, 1, -1), np.where(truth, -1, 1))
    good, poor = vote(0.95), vote(0.6)
    twin = np.where(draw.random(6000) < 0.97, poor, -poor)
    votes = np.stack([good, poor, twin], axis=1)
    given = np.where(draw.random(6000) < 0.97, np.where(truth, 1, -1), np.where(truth, -1, 1))
    both, counts = np.unique(np.column_stack([votes, given]), axis=0, return_counts=True)
    model = toxicity.label_model(both[:, :-1], both[:, -1], counts.astype(float), ["good", "poor", "twin"])
    assert model.accuracy["good"] > 0.9 > 0.7 > model.accuracy["poor"]
    assert "poor" in (model.parent["twin"], *(k for k, p in model.parent.items() if p == "twin"))


def test_pipeline_keeps_clean_documents_and_carries_columns(spark, docs):
    given = table(spark, SF, "documents")
    kept = corpus_pipeline.clean(spark, given, SF)
    assert kept.columns == given.columns
    toxic = {r.doc_id for r in table(spark, SF, "labels").collect() if r.toxic == 0}
    assert len(toxic - {r.doc_id for r in kept.collect()}) <= 0.05 * len(toxic)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near duplicates", "personal data", "mixing", "pieces"]


def test_pipeline_runs_through(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    assert got and all(r.lossless for r in got)
    assert {r.doc_id for r in got} <= {r.doc_id for r in table(spark, SF, "documents").collect()}


def test_words_of_a_text_are_looked_for_once(monkeypatch):
    class Counting:
        calls, pattern = 0, toxicity._WORD

        def findall(self, text):
            self.calls += 1
            return self.pattern.findall(text)

    count = Counting()
    monkeypatch.setattr(toxicity, "_WORD", count)
    model = toxicity.Classifier(-2.0, {"idiot": 3.0, "mor*": 1.0}, (0.0,) * len(toxicity._LEXICONS) + (1.0, 0.0, 0.0, 0.0, 0.5))
    text = "You are an idiot, you moron! A fine day."
    bits = toxicity.Voters({"mor*"})(text)
    assert count.calls == 1
    score = model.score(text)
    assert count.calls == 2
    # wits, German, French; address, twice; a mined beginning of three letters
    assert np.flatnonzero(toxicity.Voters.votes(np.array([bits]))[0]).tolist() == [0, 5, 6, 8, 12, 14]
    assert score == pytest.approx(1 / (1 + np.exp(-(-2.0 + 3.0 + 1.0 + 1.0 + 0.5))))


def test_pairs_are_found_by_their_hash():
    words = pieces.Vocabulary(*pieces.read_model(pieces.MODEL))
    work = pieces.Segmenter(words, 0.1, 1)
    lying = work.slots[work.slots < len(words.pairs)]
    assert np.array_equal(np.sort(lying), np.arange(len(words.pairs)))
    found = dict(zip(words.pairs.tolist(), words.made.tolist(), strict=True))
    draw = np.random.default_rng(3)
    left, right = draw.integers(0, words.unknown + 0x110000, (2, 50_000))
    left, right = np.append(left, words.pairs >> 32), np.append(right, words.pairs & 0xFFFFFFFF)
    want = [found.get(k, -1) for k in (left << 32 | right).tolist()]
    assert work._made(left, right).tolist() == want
