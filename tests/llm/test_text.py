import hashlib
import random
import re
import time
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from campaignlake.llm import crf, html_text, langid, pii, quality, toxicity
from campaignlake.llm.common import crc_remainder, remainder

from .tables import DOCS, docs_frame

# ---- linear-chain conditional random fields against all label sequences


def all_paths(e, moves, start):
    t, k = e.shape
    grid = np.stack(np.meshgrid(*[np.arange(k)] * t, indexing="ij"), -1).reshape(-1, t)
    score = start[grid[:, 0]] + e[np.arange(t), grid].sum(axis=1) + moves[grid[:, :-1], grid[:, 1:]].sum(axis=1)
    return grid, score


def test_crf_equals_enumeration():
    rng = np.random.default_rng(0)
    model = crf.Crf(["a", "b", "c"], rng.standard_normal((50, 3)).astype(np.float32), rng.standard_normal((3, 3)), rng.standard_normal(3))
    ids = [rng.integers(0, 50, n) for n in (6, 5, 5, 2, 1)]
    gamma = crf.posteriors(model, model.weights, ids)
    best = crf.viterbi(model, [model.weights[x] for x in ids])
    for i, x in enumerate(ids):
        grid, score = all_paths(model.weights[x], model.moves, model.start)
        p = np.exp(score - score.max())
        p /= p.sum()
        for t in range(len(x)):
            assert np.allclose(gamma[t, i], [p[grid[:, t] == c].sum() for c in range(3)], atol=1e-5)
        assert not gamma[len(x):, i].any()
        assert best[i].tolist() == grid[score.argmax()].tolist()
    assert [len(b) for b in crf.batches(np.array([3, 0, 5, 1, 1]), 6)] == [1, 2, 1]


def test_crf_gradient_is_expected_minus_seen():
    rng = np.random.default_rng(1)
    e, moves, start = rng.standard_normal((1, 4, 3)), rng.standard_normal((3, 3)), rng.standard_normal(3)
    gamma, xi = crf._expectations(e, moves, start)
    grid, score = all_paths(e[0], moves, start)
    p = np.exp(score - crf.log_sum(score[None], 1))
    assert np.allclose(gamma[0, 2], [p[grid[:, 2] == c].sum() for c in range(3)])
    want = np.zeros((3, 3))
    for path, q in zip(grid, p):
        for a, b in zip(path, path[1:]):
            want[a, b] += q
    assert np.allclose(xi, want)


# ---- language


def language_rows(n=160):
    rng = random.Random(1)
    parts = {"xx": ["ka", "lo", "mi"], "yy": ["schu", "ber", "ein"], "zz": ["eau", "que", "oi"]}
    rows = []
    for i in range(n):
        lang = list(parts)[i % 3]
        rows.append((i, " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 4))) for _ in range(30)), lang, "s", 0))
    return rows


def test_language_held_out_and_awkward(spark):
    rows = language_rows()
    odd = [(1000, None, "xx", "s", 0), (1001, "", None, "s", 0), (1002, "12 ?? --", "yy", "s", 0), (1003, rows[0][1] * 300, None, "s", 0),
           (1004, rows[0][1], "xx", "s", 0), (1004, rows[0][1], "xx", "s", 0), (None, rows[1][1], "yy", None, 0),
           (1005, f"{rows[0][1]} {rows[1][1]} {rows[1][1]}", None, "s", 0)]
    docs = docs_frame(spark, rows + odd)
    got = {}
    for r in langid.identify(docs, remainder("doc_id", 4) != 2).collect():
        got.setdefault(r["doc_id"], []).append(r)
    held = [(got[r[0]][0]["lang_pred"], r[2]) for r in rows if crc_remainder(r[0], 4) == 2]
    assert len(held) > 20 and sum(a == b for a, b in held) >= 0.98 * len(held)
    assert all((got[i][0]["lang_pred"], got[i][0]["score"]) == ("und", 0.0) for i in (1000, 1001, 1002))
    assert got[1003][0]["lang_pred"] == "xx" and got[1003][0]["n_words"] > 8000 and len(got[1004]) == 2 and got[None][0]["lang_pred"] == "yy"
    assert got[1005][0]["lang_pred"] == "yy" and 0.5 < got[1005][0]["score"] < 0.8 and 1 <= got[1005][0]["n_switches"] <= 4
    kept = langid.accepted(docs, remainder("doc_id", 4) != 2)
    assert kept.columns == docs.columns and not {1000, 1001, 1002} & {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert kept.count() == docs.count() - 3


def test_language_of_text_without_blanks(spark):
    assert langid.pieces("a" * 65) == ["a" * 30, "a" * 30, "a" * 5] and langid.pieces("") == []
    for word in ("\u4e2d\u6587\u5b57" * 40, "\u00e9" * 31, "a\u0e01\U00020000" * 30):
        cut = langid.pieces(word)
        assert "".join(cut) == word and max(len(x.encode()) for x in cut) <= 30
    assert langid.positions("a " + "b" * 31 + " " + "-" * 40 + "c") == (["a", "b" * 30, "b", "-" * 40 + "c"], 1)
    # every letter of a word is in some feature
    long = "abcdefghijklmnopqrstuvwxyz"
    rows = langid.feature_rows([long, *(long[:i] + "0" + long[i + 1:] for i in range(26))], {})
    assert all((row != rows[0]).any() for row in rows[1:])
    rows = language_rows()
    xx, yy = ("".join(t.replace(" ", "") for _, t, k, _, _ in rows if k == lang) for lang in ("xx", "yy"))
    odd = [(2000, xx[:40] + yy, None, "s", 0), (2001, f"{xx[:30]}/{yy}", None, "s", 0), (2002, yy[:40] + xx * 20, None, "s", 0)]
    got = {r["doc_id"]: r for r in langid.identify(docs_frame(spark, rows + odd), remainder("doc_id", 4) != 2).collect()}
    assert [got[i]["lang_pred"] for i in (2000, 2001, 2002)] == ["yy", "yy", "xx"]
    assert all(got[i]["score"] > 0.9 and got[i]["n_words"] == 1 and got[i]["n_switches"] >= 1 for i in (2000, 2002))


def test_even_mixes_of_languages_are_accepted(spark):
    rows = language_rows()
    odd = [(3000 + i, " ".join(rows[j][1] for j in js), None, "s", 0)
           for i, js in enumerate([(0, 1), (1, 2), (2, 0), (0, 1, 2), (2, 1, 0), (3, 1, 5), (1, 0, 5), (6, 7, 8)])]
    docs, usable = docs_frame(spark, rows + odd), remainder("doc_id", 4) != 2
    scores = {r["doc_id"]: r["score"] for r in langid.identify(docs, usable).collect()}
    assert all(scores[i] < 0.45 for i in range(3003, 3008))  # no language has half of these
    kept = {r["doc_id"] for r in langid.accepted(docs, usable).select("doc_id").collect()}
    assert {i for i, *_ in odd} <= kept


def test_language_without_labels(spark):
    docs = docs_frame(spark, [(1, "some text", None, "s", 0)])
    assert [(r["lang_pred"], r["score"]) for r in langid.identify(docs, F.lit(True)).collect()] == [("und", 0.0)]
    assert langid.identify(spark.createDataFrame([], DOCS), F.lit(True)).count() == 0


# ---- quality


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_held_out_and_awkward(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        good = i % 4 > 0
        w = [f"{rng.choice('abcdefgh')}{rng.choice(['lo', 'mi', 'ta'])}{rng.choice(['n', 's', ''])}" for _ in range(rng.randint(20, 80))]
        text = " ".join(w) + "." if good else " ".join(x.upper() + "!!" for x in w) if i % 8 else " ".join([w[0]] * 60)
        rows.append((i, text, "en", "s", 0))
        labels.append((i, int(good), None))
    labels += [(3, None, None), (None, 1, 0), (99999, 1, 0), (7, 5, 0)]
    odd = [(1000, None, "en", "s", 0), (1001, "", "en", "s", 0), (1002, rows[1][1] * 500, "en", "s", 0), (1003, "x", "en", "s", 0)]
    docs = docs_frame(spark, rows + odd + odd[:1])
    got = quality.classify(docs, labelled(spark, labels), remainder("doc_id", 3) != 1).collect()
    assert len(got) == len(rows) + 5 and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r["score"] for r in got}
    held = [(by[i] >= 0.5) == bool(k) for i, k, _ in labels[:400] if crc_remainder(i, 3) == 1]
    assert len(held) > 80 and np.mean(held) > 0.97
    none = quality.classify(docs, labelled(spark, []), F.lit(True)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.classify(spark.createDataFrame([], DOCS), labelled(spark, labels), F.lit(True)).count() == 0


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(3)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95
    assert (1, 0) in model.pairs
    bins = quality.binned(x[:5], model.edges)
    low = quality.coarse(bins, model.edges)
    z = [model.base + sum(t[b] for t, b in zip(model.tables, row)) + sum(
        t[c[i] * quality.COARSE + c[j]] for (i, j), t in zip(model.pairs, model.pair_tables)) for row, c in zip(bins, low)]
    assert np.allclose(model.score(x[:5]), 1 / (1 + np.exp(-np.array(z))))


# ---- toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    out = [i]
    for j, y in enumerate(b, 1):
        out.append(min(out[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
    return out


def test_automaton_equals_edit_distance():
    rng = random.Random(4)
    terms = ["idiot", "stupid", "scum", "worthless", "disgusting", "trash", "trance", "fool"]
    automaton = toxicity.TrieAutomaton(terms)
    letters = "aidotsupcmwrhlegnfx1"
    for _ in range(6000):
        w = list(rng.choice(terms))
        for _ in range(rng.choice([0, 1, 2, 3])):
            k = rng.randrange(len(w) + 1)
            kind = rng.randrange(3)
            if kind == 0:
                w.insert(k, rng.choice(letters))
            elif w and k < len(w):
                w[k:k + 1] = [] if kind == 1 else [rng.choice(letters)]
        w = "".join(w)
        want = min(((distance(w, t), i) for i, t in enumerate(terms) if distance(w, t) <= toxicity.edits_of(t)), default=None)
        assert automaton.match(w) == want, w


def toxic_rows(n=500):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        w = [f"{rng.choice('bcdfgk')}{rng.choice(['alo', 'emi', 'uta'])}{rng.choice(['n', 's', ''])}" for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                w[rng.randrange(40)] = rng.choice(["idiot", "stupid", "zorgfel"])
        elif i % 5 == 1:  # quoted
            k = rng.randrange(4, 34)
            w[k - 2:k + 2] = ["he", "said", '"you', 'idiot"']
        rows.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, None, int(toxic)))
    return rows, labels


def test_toxicity_held_out_and_awkward(spark):
    rows, labels = toxic_rows()
    odd = [(1000, None, "en", "s", 0), (1001, "", "en", "s", 0), (1002, rows[1][1] * 300, "en", "s", 0),
           (1003, "balo such a stupld and worthles idoit zorgfel gemi", "en", "s", 0), (1003, "balo", "en", "s", 0)]
    docs = docs_frame(spark, rows + odd)
    got = toxicity.classify(docs, labelled(spark, labels + [(None, 1, 1), (3, None, None)]), remainder("doc_id", 5) != 0).collect()
    assert len(got) == len(rows) + 5 and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got if r["doc_id"] != 1003}
    held = [(by[i]["score"] >= 0.5) == bool(k) for i, _, k in labels if crc_remainder(i, 5) == 0]
    assert len(held) > 60 and np.mean(held) > 0.97
    both = sorted((r for r in got if r["doc_id"] == 1003), key=lambda r: r["score"])
    assert both[1]["n_misspelled"] >= 2 and both[1]["score"] > 0.5 > both[0]["score"] and by[1000]["score"] < 0.5
    assert {r["score"] for r in toxicity.classify(docs, labelled(spark, []), F.lit(True)).collect()} == {0.5}
    assert toxicity.classify(spark.createDataFrame([], DOCS), labelled(spark, labels), F.lit(True)).count() == 0


# ---- personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d)))
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 12 <= len(d) <= 19 and total % 10 == 0 or kind == "phone" and 9 <= len(d) <= 15):
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda x: (x[1], list(PATTERNS).index(x[0])))


def test_base_spans_equal_plain_patterns():
    rng = random.Random(6)
    pieces = ["@", ".", "-", " ", "a", "b7", "1", "22", "255", "256", "+4", "(", ")", "é", "\n", "4111 1111 1111 1111", "_%", "x@y.z",
              "1.2.3.4", "0000255", "+1 (168) 555-5254", "..", "@@"]
    for _ in range(6000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == plain_spans(text), text
    long = "a" * 200_000 + "1" * 200_000 + "@" + "1." * 50_000 + " +" + "(" * 100_000
    assert pii.base_spans(long)[0] == ("email", 0, 400_001 + 99_999)


def test_field_adds_what_patterns_miss():
    model, hashed = pii.fit(), pii.Hashed()
    texts = ["please call 415-555-0173 or (212) 555-0188 soon", "mail bob (at) example (dot) org today",
             "in 1999 there were 12 items , chapter 3.2 and 1,250 more", "the quick brown fox", ""]
    got = [every for _, every in pii.scan(texts, model, hashed)]
    assert [texts[0][s:e] for k, s, e in got[0] if k == "phone"] == ["415-555-0173", "(212) 555-0188"]
    assert [k for k, _, _ in got[1]] == ["email"] or got[1] == []
    assert got[2] == got[3] == got[4] == []
    for line in pii.LABELLED.strip().split("\n"):
        text, spans = pii.parse_labelled(line)
        for base, every in pii.scan([text], model, hashed):
            assert set(base) <= set(every)


def test_spelled_out_addresses_are_found():
    model, hashed = pii.fit(), pii.Hashed()
    for address in ("bob (at) example (dot) com", "j_doe42 (at) example (dot) com", "r.smith [at] post [dot] example [dot] org",
                    "Anna (AT) web (DOT) org"):
        for before, after in (("mail", "today"), ("plain words " * 50 + "so please write to", "now " + "and more words " * 50)):
            text = f"{before} {address} {after}"
            (_, every), = pii.scan([text], model, hashed)
            assert [(k, text[s:e]) for k, s, e in every] == [("email", address)]
            assert pii.masked(text, every) == f"{before} <email> {after}"
    texts = ["area 10 \u00b2 and \u2460 of \u0663", "(at) noon"]
    assert [every for _, every in pii.scan(texts, model, hashed)] == [[], []]


def test_islands_equal_whole_texts():
    model, hashed, rng = pii.fit(), pii.Hashed(), random.Random(8)
    lines = [pii.parse_labelled(x)[0] for x in pii.LABELLED.strip().split("\n")]
    plain = ["the", "of", "and", "word", "they", "went", "home"]
    texts = [" ".join(x for _ in range(6) for x in (rng.choice(lines), *rng.choices(plain, k=rng.randint(8, 30)))) for _ in range(60)]
    base = [pii.base_spans(t) for t in texts]
    got = pii.found_spans(texts, base, model, hashed)
    islands = pii.islands
    try:
        pii.islands = lambda text: [(0, len(text))]
        assert list(map(sorted, got)) == list(map(sorted, pii.found_spans(texts, base, model, hashed)))
    finally:
        pii.islands = islands
    assert sum(map(len, got)) > 100


def test_one_long_island_is_decoded_in_little_memory():
    model, hashed, rng = pii.fit(), pii.Hashed(), random.Random(4)
    words = ["415-555-0199", "10.20.30.40", "+44 20 7946 0018", "kim (at) example (dot) org", "12", "no"]
    text = " ".join(rng.choice(words) for _ in range(12_000))
    toks = pii.tokens(text, 0, len(text))
    assert len(pii.islands(text)) == 1 and len(toks) > 50_000
    tracemalloc.start()
    try:
        got, = pii.found_spans([text], [[]], model, hashed)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 400 * len(toks) and len(got) > 1000
    assert len(toks) > 10 * pii.PIECE_TOKENS
    e = model.weights[pii.features(text, toks, hashed)].sum(axis=1)
    assert np.array_equal(e, pii.emissions(text, np.array(toks), model, hashed))


def test_personal_data_rows(spark):
    text = "write to ann.lee@mail.example.com or +1 (168) 555-5254 from 10.0.0.7"
    rows = [(1, text, "en", "s", len(text)), (1, text, "en", "s", len(text)), (2, None, "en", "s", None), (3, "", "en", "s", 0),
            (4, "word " * 30_000 + text, "en", "s", 1), (None, "x", None, None, 1)]
    docs = docs_frame(spark, rows)
    got = {}
    for r in pii.find(docs).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert len(got[1]) == 2
    for i, t in ((1, text), (2, ""), (3, ""), (4, rows[4][1])):
        base = plain_spans(t)
        r = got[i][0]
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(x[0] == k for x in base) for k in PATTERNS] and r["spans"] == joined
    masked = pii.redact(docs)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    new = {r["doc_id"]: (r["text"], r["n_chars"]) for r in masked.collect()}
    want = "write to <email> or <phone> from <ip>"
    assert new[1] == (want, len(want)) and new[2] == (None, None) and new[3] == ("", 0) and new[None] == ("x", 1)
    assert pii.find(spark.createDataFrame([], DOCS)).count() == 0


# ---- pages

LONG_A = "The cat of the house and the dog is in the garden with a friend, and it was on that day that they met."
LONG_B = "It is for the people of this town that the work was done, and they have not seen it as it is now."


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<html></html>", ""), ("<script>the and of", ""), ("<!-- the", ""),
    (f"<nav><a href=x>The and of</a></nav><article><h1>Head &amp; shoulders</h1><p>{LONG_A}<p>Short.</article><footer>{LONG_B}</footer>",
     f"Head & shoulders\n{LONG_A}\nShort."),
    (f"<header><h1>Site</h1></header><main><p>{LONG_A}</p><div class='comments'><p>{LONG_B}</p></div><p>x  y\n z</p></main><aside>{LONG_B}</aside>",
     f"{LONG_A}\nx y z"),
    (f"<div id=cookie-notice>{LONG_B}</div><div><p>{LONG_A}</p><p>And so.</p><p>{LONG_B}</p></div><ul><li><a href=1>one</a><li><a href=2>two</a></ul>",
     f"{LONG_A}\nAnd so.\n{LONG_B}"),
    (f"<div class=ad>{LONG_B}</div><article><p><b>{LONG_A[:50]}</b>{LONG_A[50:]}<br><p><form><p>{LONG_B}</p></form><p style='display:none'>{LONG_B}"
     "</p></article>", None),
    (f"<nav><article><p>{LONG_A} &lt;p&gt; a &lt; b &eacute;&#233;&nbsp;x</p></article>", f"{LONG_A} <p> a < b éé x"),
])
def test_pages(page, text):
    got = html_text.main_text(page)
    if text is not None:
        assert got == text
    else:
        assert got.startswith(LONG_A) and "form" not in got


@pytest.mark.parametrize("page,text", [
    (f"<div class='layout {name}'><article><p>{LONG_A}</p></article></div>", LONG_A) for name in ("has-sidebar", "no-sidebar", "menu", "search-page")
] + [
    (f"<article class='post category-legal'><p>{LONG_A}</p></article>", LONG_A),
    (f"<main class='with-menu'><p>{LONG_A}</p><p class='notice'>{LONG_B}</p></main>", f"{LONG_A}\n{LONG_B}"),
    (f"<section id='search-results'><p>{LONG_A}</p><p>{LONG_B}</p></section><div class=ad>{LONG_B}</div>", f"{LONG_A}\n{LONG_B}"),
    (f"<article class=social><div class=widget><p>{LONG_A}</p></div></article>", LONG_A),
    (f"<article><p>{LONG_A}</p><figure><img src=x><figcaption>The cat.</figcaption></figure><p>{LONG_B}</p></article>",
     f"{LONG_A}\nThe cat.\n{LONG_B}"),
])
def test_names_do_not_remove_the_text(page, text):
    assert html_text.main_text(page) == text


def test_page_rows(spark):
    pages = spark.createDataFrame([(1, "u", f"<p>{LONG_A}</p>", "x"), (1, "u", f"<p>{LONG_A}</p>", "x"), (2, None, None, "x"),
                                   (None, "u", "<p>" + LONG_A * 3000, "x")], "page_id long, url string, html string, text string")
    rows = html_text.extract(pages).collect()
    assert sorted((str(r["page_id"]), r["n_chars"]) for r in rows) == [("1", len(LONG_A)), ("1", len(LONG_A)), ("2", 0), ("None", 3000 * len(LONG_A))]
    assert html_text.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["comment-list", "comments-area", "user-comments", "ad-container", "related-posts", "share-buttons",
                                  "newsletter-signup", "commentList", "cookie_notice", "ads"])
def test_named_parts_of_an_article(name):
    page = f"<article><p>{LONG_A}</p><div class='{name}'><p>{LONG_A * 20} inner</p><article><p>{LONG_A} more</p></article></div></article>"
    assert html_text.main_text(page) == LONG_A
    page = f"<article><p>{LONG_A}</p></article><section class='x {name}'><article><p>{LONG_A * 20} inner</p></article></section>"
    assert html_text.main_text(page) == LONG_A


@pytest.mark.parametrize("name", ["layout has-sidebar", "no-sidebar", "category-legal", "search-results", "with-menu", "sidebar", "threads"])
def test_names_around_an_article(name):
    assert html_text.main_text(f"<div class='{name}'><article><p>{LONG_A}</p></article></div>") == LONG_A


def test_nesting_is_linear():
    times = []
    for n in (4000, 16000):
        pages = ["<div>" * n + "</span>" * n, "<article>" * n + "</nav>" * n, "<div class=ad><article>" * n, "<nav><article>" * n]
        start = time.perf_counter()
        for page in pages:
            html_text.main_text(page + f"<p>{LONG_A}</p>")
        times.append(time.perf_counter() - start)
    assert times[1] < 8 * times[0] + 0.5
