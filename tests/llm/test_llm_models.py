"""Operators beyond SQL, against brute force, hand-worked cases and held-out accuracy."""

import collections
import math
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from helpers import EDGES, docs, words
from pyspark.sql import functions as F

from hazardflow.llm import ann, batches, html_extract, near_dedup, quality
from hazardflow.llm.components import components

# ---------------------------------------------------------------- words and signatures


def test_words_equal_the_regular_expression():
    rng = random.Random(1)
    texts = ["", "a", " ", "É é.Z", *("".join(rng.choice("aZ 9é.\n漢🙂-_") for _ in range(rng.randrange(40))) for _ in range(300))]
    w = batches.Words(pa.array(texts))
    seen = {}
    for d, t in enumerate(texts):
        want = words(t)
        assert w.counts[d] == len(want)
        for i, x in enumerate(want):
            at = w.first[d] + i
            assert w.text_at(at, 1).decode() == x
            assert seen.setdefault(x, w.hashes[at]) == w.hashes[at]
    assert len(set(seen.values())) == len(seen)


def bag(text, n=5):
    w = words(text)
    return collections.Counter(tuple(w[i: i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else collections.Counter([tuple(w)] if w else [])


def jaccard(a, b):
    a, b = bag(a), bag(b)
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def test_signatures_are_unbiased_for_weighted_jaccard():
    rng = np.random.default_rng(0)
    z = []
    for t in range(30):
        a = [f"w{i}" for i in rng.integers(0, 2000, 250)]
        b = list(a)
        for i in rng.choice(250, rng.integers(1, 25), replace=False):
            b[i] = f"x{rng.integers(2000)}"
        if t % 2:
            a, b = a[:30] * 9, b[:30] * 5
        a, b = " ".join(a), " ".join(b)
        w = batches.Words(pa.array([a, b]))
        s = near_dedup.bag_minhash(*near_dedup._bags(w, 5), 2)
        true = jaccard(a, b)
        assert near_dedup.bag_similarity(pa.array([a]), pa.array([b]))[0] == pytest.approx(true)
        assert near_dedup.overlap_matrix(pa.array([a, b]), pa.array([b, "", a]))[0, 0] == pytest.approx(true, abs=1e-6)
        z.append(((s[0] == s[1]).mean() - true) / (math.sqrt(true * (1 - true) / near_dedup.M) + 1e-9))
    assert abs(np.mean(z)) < 0.6 and np.std(z) < 1.7


def brute_classes(rows):
    keys = [(r[0], r[1] or "") for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if find(i) != find(j) and jaccard(rows[i][1], rows[j][1]) >= 0.8:
                parent[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    least = {}
    for members in groups.values():
        ids = [keys[i][0] for i in members]
        for i in members:
            least[i] = None if None in ids else min(ids)
    return collections.Counter((keys[i][0], least[i]) for i in range(len(rows)))


def test_near_classes_equal_brute_force_with_a_dense_group(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL", 8)  # so that the large group is compared in chunks
    monkeypatch.setattr(near_dedup, "CHUNK", 16)
    rng = random.Random(2)
    base = [f"b{i}" for i in range(60)]
    rows = [r[:2] for r in EDGES if r[0] != 7]
    for i in range(120):  # copies of one text, many just below the threshold to each other
        t = list(base)
        for k in rng.sample(range(60), rng.choice([0, 1, 1, 2, 3])):
            t[k] = f"n{rng.randrange(9999)}"
        rows.append((1000 + i, " ".join(t)))
    for i in range(60):
        rows.append((2000 + i, " ".join(f"q{rng.randrange(9999)}" for _ in range(40)) + " " + " ".join(base[:20])))
    got = near_dedup.near_duplicate_classes(docs(spark, rows)).collect()
    assert collections.Counter((r._id, r.class_id) for r in got) == brute_classes(rows)


def test_near_duplicates_keep_one_row_of_each_class(spark):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(5, text), (3, text.replace("w50", "x")), (3, text.replace("w50", "x")), (9, "else " + text[:40]), (None, ""), (4, None)]
    df = docs(spark, rows)
    kept = near_dedup.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, 3), (False, 9), (True, None)]
    assert near_dedup.drop_near_duplicates(df.limit(0)).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}


# ---------------------------------------------------------------- quality classifier


def brute_perplexities(texts, folds, trusted, order):
    """Interpolated modified Kneser-Ney by dictionaries; discounts pooled over the two models."""
    grams = {}
    for f in (0, 1):
        top = collections.Counter()
        for t, g, ok in zip(texts, folds, trusted):
            if ok and g == f:
                b = b"\0" * (order - 1) + t.encode()
                top.update(b[i: i + order] for i in range(len(b) - order + 1))
        level = {order: top}
        for k in range(order - 1, 0, -1):
            level[k] = collections.Counter(g[1:] for g in level[k + 1])
        grams[f] = level
    discount = {}
    for k in range(1, order + 1):
        counts = collections.Counter(n for f in (0, 1) for n in grams[f][k].values())
        discount[k] = quality.discounts(counts)
    context = {f: {k: collections.defaultdict(lambda: [0, 0.0]) for k in range(1, order + 1)} for f in (0, 1)}
    for f in (0, 1):
        for k in range(1, order + 1):
            for g, n in grams[f][k].items():
                c = context[f][k][g[:-1]]
                c[0] += n
                c[1] += discount[k][min(n, 3) - 1]
    out = []
    for t, g in zip(texts, folds):
        f, b, logs = 1 - g, b"\0" * (order - 1) + t.encode(), []
        for i in range(order - 1, len(b)):
            p = 1 / 256
            for k in range(1, order + 1):
                gram = b[i - k + 1: i + 1]
                n, c = grams[f][k].get(gram, 0), context[f][k].get(gram[:-1])
                if c:
                    p = (max(0.0, n - discount[k][min(n, 3) - 1]) if n else 0.0) / c[0] + c[1] / c[0] * p
            logs.append(math.log(p))
        out.append(math.exp(-sum(logs) / len(logs)) if logs else None)
    return out


def test_perplexities_equal_brute_force(spark):
    rng = random.Random(4)
    rows = [r for r in EDGES if r[0] not in (7,)] + [(100 + i, " ".join(rng.choice(["der", "die", "und", "haus", "ÄÖ"]) for _ in range(rng.randrange(30)))) for i in range(60)]
    df = docs(spark, [(r[0], r[1], "de" if i % 3 else None, "s") for i, r in enumerate(rows)])
    labels = spark.createDataFrame([(100 + i, int(i % 5 > 0), int(i % 7 == 0), "x") for i in range(40)] + [(None, 1, 0, "x"), (101, 0, 0, "x"), (5, 1, None, "x")],
                                   "doc_id long, quality int, toxic int, text string")
    ok = {r["_trusted"] for r in quality.trusted_ids(labels).collect()}
    assert 101 not in ok and 5 in ok and None not in ok
    folds = [r.f for r in spark.createDataFrame([(i, r[1] or "") for i, r in enumerate(rows)], "i int, t string").select(
        "i", quality.fold_of(F.xxhash64("t")).alias("f")).orderBy("i").collect()]
    want = brute_perplexities([r[1] or "" for r in rows], folds, [r[0] in ok for r in rows], 3)
    got = quality.judge_quality(df, labels, order=3, block_bytes=256).collect()
    by = collections.defaultdict(list)
    for r, p in zip(rows, want):
        by[r[0]].append(p)
    assert len(got) == len(rows)
    for r in got:
        assert any(r.perplexity is p or (p and r.perplexity == pytest.approx(p, rel=1e-9)) for p in by[r._id])
        assert r.keep == (r.perplexity is not None and r.perplexity <= r.threshold)


def test_classifier_drops_noise_and_keeps_clean_text(spark):
    rng = random.Random(6)
    vocabulary = ["the", "house", "stands", "near", "a", "river", "and", "green", "fields"]
    clean = [(i, " ".join(rng.choice(vocabulary) for _ in range(80))) for i in range(300)]
    noise = [(1000 + i, " ".join(rng.choice(vocabulary).upper() + "!!%" for _ in range(80))) for i in range(40)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(150)], "doc_id long, quality int, toxic int")
    df = docs(spark, clean + noise + [(5000, None), (5001, "")])
    kept = quality.drop_poor(df, labels)
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == df.columns
    assert not ids & {n[0] for n in noise} and not ids & {5000, 5001}
    assert len(ids) >= 290
    assert quality.drop_poor(df, labels.limit(0)).count() == len(clean) + len(noise)  # nothing trusted: no threshold
    assert quality.drop_poor(df.limit(0), labels).count() == 0


def test_quality_thresholds_by_length_band_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        lang = [None, "en", "de", "fr"][i % 4] if i % 9 else "en"
        rows.append((i, i % 350, lang, int(4 ** rng.uniform(0, 6)), float(np.exp(rng.normal(2, 0.5)))))  # texts repeat
    rows = [(i, h, lang, *rows[h][3:]) for i, h, lang, _, _ in rows] + [(900, 900, "xx", 0, None)]
    scores = spark.createDataFrame(rows, "_id long, _h long, lang string, n_bytes long, perplexity double")
    ids = spark.range(300).select(F.col("id").alias("_trusted")).unionByName(spark.createDataFrame([(900,)], "_trusted long"))
    parts: dict = {}
    for lang, n, h, b in {(lang or "(none)", n, h, math.floor(math.log(p) * quality.BINS)) for i, h, lang, n, p in rows if i < 300}:
        for key in ((lang, (n.bit_length() - 1) // 2), (lang, None), (None, None)):
            parts.setdefault(key, []).append(b)
    limit = {k: math.exp((sorted(v)[math.ceil(len(v) * 0.9 - 1e-9) - 1] + 1) / quality.BINS) for k, v in parts.items()}
    got = {(r["_lang"], r["_band"]): r["threshold"] for r in quality.thresholds(scores, ids, 0.9, 12).collect()}
    assert {k[0] for k in got} == {"(none)", "en", "de", "fr", None} and len(got) == 4 * 32 + 1
    assert any(len(v) >= 12 for k, v in parts.items() if k[1] is not None)
    for (lang, band), threshold in got.items():
        own = band is not None and len(parts.get((lang, band), [])) >= 12
        assert threshold == pytest.approx(limit[lang, band if own else None])


def test_long_texts_are_held_against_long_ones(spark):
    rng = np.random.default_rng(6)
    words = "the of and to in is was for with that".split() + ["".join(rng.choice(["th", "er", "an", "in", "on", "re"], 3)) for _ in range(60)]
    short = [" ".join(rng.choice(words, 2)) if i % 10 else f"{rng.integers(1 << 40):X}#" for i in range(600)]
    prose = short + [" ".join(rng.choice(words, 120)) for _ in range(600)]
    junk = [" ".join(w if i % 3 else w.upper() + "$" for i, w in enumerate(rng.choice(words, 120))) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(prose + junk)), "doc_id long, text string").withColumn("lang", F.lit("en"))
    labels = spark.range(1200).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    judged = {r["_id"]: r for r in quality.judge_quality(df, labels).collect()}
    assert not any(judged[i].keep for i in range(1200, 1220))
    assert sum(judged[i].keep for i in range(1200)) >= 0.98 * 1200
    one = {r["_id"]: r.threshold for r in quality.judge_quality(df, labels, band_texts=10 ** 9).collect()}
    assert len(set(one.values())) == 1 and all(judged[i].threshold < one[i] for i in range(600, 1220))


# ---------------------------------------------------------------- html


P = " ".join(f"word{i}" for i in range(40))


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("<!-- open <p>x", ""), ("plain &amp; text", "plain & text"),
    (f"<head><title>T</title></head><body><nav><a>m</a></nav><article><h1>H&eacute;</h1><p>{P}<p>a&nbsp;b<br>c<em>d</em></article><footer>f</footer>",
     f"Hé\n{P}\na b cd"),
    (f"<body><div class='mainSidebar'>buy {P}</div><div class=post><p>{P}</p><aside>{P}</aside><p>end {P}</p></div><div id=comments><p>{P}</p></div>",
     f"{P}\nend {P}"),
    (f"<article><p>{P}</p><form><label>{P} {P}</label></form><script>var a='<p>no</p>'</script><p>last one</p><section class=comments>{P}</section></article>",
     f"{P}\nlast one"),
    (f"<ul><li><a href=x>Home</a><li><a>News</a></ul><main><ul><li>one {P}<li>two</ul></main>", f"one {P}\ntwo"),
    (f"<article><div hidden>{P}</div><p>{P}<b>unclosed<p>next</article>", f"{P}unclosed\nnext"),
])
def test_main_text_of_hand_made_pages(page, text):
    weights = html_extract.fitted_weights({"word plain in": 900, "word plain none": 900, "tag p in": 50, "tag p none": 50},
                                          {"word never out": 300, "word never none": 300, "tag li out": 40, "tag li none": 10})
    assert html_extract.main_text(page or "", weights) == text


@pytest.mark.parametrize(("page", "text"), [
    (f"<!-- <article> --><div class=post><p>{P}</p></div>", P),
    (f"<script>var a='<main>'</script><template><article></article></template><div class=post><p>{P}</p></div>", P),
    (f"<aside><article><p>{P}</p></article></aside><div class=post><p>{P}</p></div>", P),
    (f"<div class=post><p>{P}<p>{P}<p>{P}</div><section class=related><article><p>{P}</p></article></section>", f"{P}\n{P}\n{P}"),
    (f"<div class=post><p>{P}</p></div><div><article><p>a b c</p></article><article><p>d e</p></article></div>", f"{P}\na b c\nd e"),
    (f"<div class=post><p>{P}</p></div><article><img src=x></article>", P),
])
def test_false_marks_and_cards_do_not_lose_the_main_text(page, text):
    assert html_extract.main_text(page, {}) == text
    fitted = html_extract.fitted_weights({"word plain in": 900, "word plain none": 900}, {"word plain out": 30, "word never none": 300})
    assert html_extract.main_text(page, fitted) == text


def test_training_pages_are_those_whose_elements_mark_the_main_text(spark):
    true = [(f"<div>{P} {i}</div><article><p>{P} {P} {P}</p></article>",) for i in range(6)]
    false = [(f"<!-- <main> --><div class=post>{P} {i}</div>",) for i in range(40)] + [(f"<aside><article>x</article></aside><p>{P} {i}",) for i in range(40)]
    want = html_extract.learn_weights(spark.createDataFrame(true, "html string"))
    assert "word plain out" in want
    assert html_extract.learn_weights(spark.createDataFrame(true + false, "html string")) == want
    assert html_extract.learn_weights(spark.createDataFrame(true + false, "html string"), training_pages=6) == want
    assert html_extract.learn_weights(spark.createDataFrame(false, "html string")) == {}


Q = " ".join(f"box{i}" for i in range(100))
SHORT = "closing words of the text are only eight"


@pytest.mark.parametrize(("page", "text"), [
    (f"<div class=post><p>{P} {P} {P}</p><div class=newsletter><p>{Q}</p></div><p>{SHORT}</p></div>", f"{P} {P} {P}\n{SHORT}"),
    (f"<div class=post><p>{SHORT}</p><form>{'<p><select><option>x</select>' * 60}{Q}</form><p>{P} {P}</p></div>", f"{SHORT}\n{P} {P}"),
    (f"<div class=post><div>{P}</div><div><aside>{Q}</aside></div><div>{SHORT}</div></div>", f"{P}\n{SHORT}"),
    (f"<div id=page><div class=post><p>{P}</p><p>{P}</p></div><aside>{Q}</aside><div class=legal>all rights</div></div>", f"{P}\n{P}"),
])
def test_long_boxes_do_not_cut_short_paragraphs_off_unmarked_pages(page, text):
    assert html_extract.main_text(page, {}) == text


ARTICLE = f"<article><h1>Head</h1><p>{P}</p><p>{SHORT}</p></article>"


@pytest.mark.parametrize("page", [
    f'<div id="page" class="right-sidebar"><main><h1>Head</h1><p>{P}</p><p>{SHORT}</p></main><div class="sidebar">{Q}</div></div>',
    *[f'<body class="{c}"><div class="{c}"><nav><a>x</a> menu</nav>{ARTICLE}<div id="comments">{Q} {Q}</div></div>'
      for c in ("has-sidebar", "no-sidebar", "site cookies-accepted", "wrap menu-closed", "left sidebar", "page header-banner")],
    f'<form id="aspnet" action="/"><div class="menu">{SHORT}</div>{ARTICLE}<input name=q></form>',
    f"<form id=f><div class=post><h1>Head</h1><p>{P}</p><p>{SHORT}</p></div></form>",
    f"<nav><a href=/>Home</a><a href=/n>News</a>{ARTICLE}<footer>{Q}</footer>",
    f"<header><a href=/>Logo</a>{ARTICLE}<aside>{Q}</aside>",
    f'<header><nav><div class="top-menu"><a>Home</a>{ARTICLE}',
    f'<div class="modal-open page-wrap"><div class="sidebar-left container">{ARTICLE}</div></div>',
])
def test_wrappers_do_not_veto_the_page(page):
    for weights in ({}, html_extract.fitted_weights({"word plain in": 900, "word plain none": 900, "tag p in": 50},
                                                    {"word plain out": 300, "word never none": 300, "word link out": 90})):
        assert html_extract.main_text(page, weights) == f"Head\n{P}\n{SHORT}"


def test_paragraphs_named_like_boxes_stay_and_boxes_go():
    page = (f'<article><section id="related-work"><p>{P}</p></section><p class="share-price">{SHORT}</p><div class="related-posts">{Q}</div>'
            f'<div class="share-buttons">a b</div><p id="ad-1">buy</p><div role="complementary">{Q}</div><p class="no-comment">last words</p></article>')
    assert html_extract.main_text(page, {}) == f"{P}\n{SHORT}\nlast words"


@pytest.mark.parametrize("page", [f"<div class=comments><p>{P} {Q}</p></div><div class=post><p>{SHORT}</p></div>",
                                  f"<p>{SHORT}</p><section id=comments>{f'<article><p>{Q}</p></article>' * 5}</section>"])
def test_comments_go_even_where_they_are_most_of_the_page(page):
    assert html_extract.main_text(page, {}) == SHORT


@pytest.mark.parametrize("piece", ['<a "', "<a '", "<", "</", "<!-", "<a b='\"'>", "<p", '<a ">', "<div class='x", "<script>", "<svg>", "<!x"])
def test_long_pages_of_broken_tags_take_linear_time(piece):
    begin = time.perf_counter()
    html_extract.main_text(piece * (2_000_000 // len(piece)), {})
    assert time.perf_counter() - begin < 40


@pytest.mark.parametrize(("page", "text"), [
    ('<p>a <b title="x>y">b</b> c</p>', "a b c"), ("<p>a < b and 3<4 > 2</p>", "a < b and 3<4 > 2"), ("<p>one<a href='x>two</p><p>three", "onetwo\nthree"),
    ("<p>one</p><p title=\"open>two</p>", "one\ntwo"), ("a<script>b</SCRIPT >c<svg/>d<style>e", "acd"), ("x <? y > z <!doctype q> w", "x z w"),
])
def test_scanner_of_odd_markup(page, text):
    assert html_extract.main_text(page, {}) == text


def test_best_run_is_the_maximum():
    rng = random.Random(8)
    for _ in range(300):
        x = [rng.randrange(-5, 6) for _ in range(rng.randrange(0, 15))]
        b, e = html_extract.best_run(x)
        best = max([0] + [sum(x[i:j]) for i in range(len(x)) for j in range(i + 1, len(x) + 1)])
        assert sum(x[b:e]) == best


def test_extraction_of_a_table(spark):
    rows = [(1, "u", f"<article><p>{P}</p></article><div class=x>{P}</div>", "t", 5), (1, "u", None, "t", 5), (None, None, "", "t", 5),
            (2, "v", "<article><p>" + "long " * 200_000 + "</p></article>", "t", 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = {(r.page_id, len(r.text)): r.n_chars for r in html_extract.extract_text(df).collect()}
    assert got == {(1, len(P)): len(P), (1, 0): 0, (None, 0): 0, (2, 999_999): 999_999}
    assert html_extract.extract_text(df.limit(0)).count() == 0


# ---------------------------------------------------------------- nearest neighbours


def test_nearest_neighbours_recall_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((900, 12)) * rng.uniform(0.5, 2.0, (900, 1))
    rows = [(i, [float(v) for v in x[i]], "g") for i in range(900)]
    rows += [(1000 + i, [float(v) for v in x[20]], "g") for i in range(60)]  # many copies of one vector
    bad = [(2000, None, "g"), (2001, [0.0] * 12, "g"), (2002, [float("nan")] + [1.0] * 11, "g"), (2003, [None] + [1.0] * 11, "g"),
           (2004, [1.0], "g"), (2005, [float("inf")] * 12, "g"), (None, [1.0] * 12, "g")]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, node string")
    got = collections.defaultdict(list)
    for r in ann.nearest(df, F.col("id") % 20 == 0).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    ids, every = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    queries = [i for i in ids if i % 20 == 0]
    assert sorted(got) == sorted(queries)
    shares = []
    for q in queries:
        score = every @ every[list(ids).index(q)]
        order = [j for j in np.lexsort((ids, -np.round(score, 9))) if ids[j] != q][:20]
        found = sorted(got[q])
        assert [f[0] for f in found] == list(range(1, 21))
        shares.append(len({ids[j] for j in order} & {f[1] for f in found}) / 20)
    assert np.mean(shares) >= 0.97


def recall(spark, x, checked=20):
    """Share of the exact ``checked`` nearest (inner product) that the operator finds, over the rows 0, 20, 40.."""
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = collections.defaultdict(set)
    for r in ann.nearest(df, F.col("id") % 20 == 0).collect():
        got[r.query_id].add(r.vec_id)
    shares = []
    for q in range(0, len(x), 20):
        score = x @ x[q]
        score[q] = -np.inf
        shares.append(len(set(np.argsort(-score)[:checked].tolist()) & got[q]) / checked)
    return np.mean(shares)


@pytest.mark.parametrize("length", [1e3, 1e8, 1e-6])
def test_a_few_very_long_or_short_vectors_do_not_change_the_recall(spark, length):
    rng = np.random.default_rng(11)
    x = rng.standard_normal((1500, 24))
    x[[7, 300, 777]] *= length
    assert recall(spark, x) >= 0.97


def test_recall_over_many_lengths(spark):
    rng = np.random.default_rng(12)
    x = rng.standard_normal((2400, 16)) * np.where(np.arange(2400) % 2, 1.0, 30.0)[:, None]
    x[::100] *= 10.0 ** rng.uniform(-9, 9, (24, 1))
    assert recall(spark, x) >= 0.97


def test_nobody_asks(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0])], "vec_id long, embedding array<float>")
    assert ann.nearest(df, F.col("id") % 20 == 0).count() == 0


def test_repeated_rows_do_not_hide_other_ids_with_their_vector(spark):
    rows = [(0, [1.0, 0.0])] + [(3, [0.9, 0.1])] * 25 + [(i, [0.9, 0.1]) for i in (40, 60)] + [(7, [0.0, 1.0])] * 3
    df = spark.createDataFrame([r for r in rows], "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in ann.nearest(df, F.col("id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert got == {0: [3] * 20, 40: [0] + [3] * 19, 60: [0] + [3] * 19}
    few = df.where("vec_id <> 3").union(df.where("vec_id = 3").limit(2))
    assert [r.vec_id for r in ann.nearest(few, F.col("id") == 0).orderBy("rank").collect()] == [3, 3, 40, 60, 7, 7, 7]
    rows = df.where("vec_id = 3").union(df.where("vec_id in (40, 60)"))
    assert [r.vec_id for r in ann.nearest(rows, F.col("id") == 3).collect()] == [40, 60]


def node_vectors(spark, x):
    unit = np.concatenate([x / np.linalg.norm(x, axis=1, keepdims=True), np.zeros((len(x), 1))], axis=1).astype(np.float16)
    return spark.createDataFrame([(i, bytearray(v.tobytes())) for i, v in enumerate(unit)], "node long, vec binary").cache()


def test_descent_goes_on_until_few_lists_change(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(ann, "written", lambda df, name, write=ann.written: rounds.append(name) or write(df, name))
    rng = np.random.default_rng(13)
    nodes = node_vectors(spark, rng.standard_normal((3000, 32)))
    ann.build_graph(nodes, 3000)
    assert rounds.count("lists") > 3
    rounds.clear()
    ann.build_graph(nodes, 3000, changed=1.0)
    assert rounds == ["start", "graph"]


def test_beam_is_doubled_until_the_probes_find_their_neighbours(spark):
    x = np.random.default_rng(14).standard_normal((3000, 64))
    nodes = node_vectors(spark, x)
    graph = ann.build_graph(nodes, 3000, changed=1.0)  # the first lists only
    asking = nodes.where("node % 40 = 0").withColumn("starts", F.array("node"))

    def share(beams):
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        return np.mean([len(set(np.argsort(-(unit @ unit[r.node]))[:20].tolist()) & set(r.ids)) / 20 for r in beams.collect()])

    assert share(ann.search(asking, graph, nodes, beam=24, expand=8)) < 0.9
    assert share(ann.sure_search(asking, graph, nodes, 20, beam=24, expand=8)) >= 0.9


def test_only_the_probes_are_searched_again_with_a_larger_beam(spark, monkeypatch):
    x = np.random.default_rng(16).standard_normal((1500, 32))
    nodes = node_vectors(spark, x)
    asked = []

    def searched(queries, graph, nodes, *, beam, expand):
        asked.append((queries.count(), beam))
        unit = _units(x)
        rows = [(r.node, [int(i) for i in order[:beam]], [float(unit[r.node] @ unit[i]) for i in order[:beam]])
                for r in queries.collect() for order in [np.argsort(-(unit @ unit[r.node]), kind="stable")]]
        return spark.createDataFrame(rows, "node long, ids array<long>, scores array<float>")

    monkeypatch.setattr(ann, "search", searched)
    monkeypatch.setattr(ann, "SAME", np.float32(1e-3))
    beams = ann.sure_search(nodes.where("node % 5 = 0").withColumn("starts", F.array("node")), None, nodes, 20, beam=8, expand=4)
    assert sorted(r.node for r in beams.collect()) == list(range(0, 1500, 5))
    assert asked == [(ann.PROBES, 8), (ann.PROBES, 16), (ann.PROBES, 32), (300 - ann.PROBES, 32)]


def _units(x):
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float16).astype(np.float64)


def test_nodes_that_met_do_not_meet_again():
    rng = np.random.default_rng(17)
    x = _units(rng.standard_normal((60, 16)))
    last = rng.uniform(-0.2, 0.2, 60).astype(np.float32)
    answers = pa.table({"at": [0] * 60, "id": np.arange(60), "home": np.arange(60) % 3, "last": last, "vec": pa.array([v.astype(np.float16).tobytes() for v in x])})
    both = [[int(i) for i in rng.choice(np.setdiff1d(np.arange(60), [u]), 12, replace=False)] for u in range(20)]
    for fresh in (0, 5, 12):
        state = pa.table({"block": [0] * 20, "node": np.arange(20), "both": pa.array(both, pa.list_(pa.int64())), "fresh": [fresh] * 20})
        want = collections.defaultdict(dict)
        for u in range(20):
            met, new = [u, *both[u][: 12 - fresh]], both[u][12 - fresh:]
            for i in met + new:
                for j in met + new:
                    if i != j and (i in new or j in new) and x[i] @ x[j] > last[i]:
                        want[i][j] = x[i] @ x[j]
        got = {r["id"]: r for r in ann._local_join(state, answers).to_pylist()}
        assert set(got) == set(want)
        for i, r in got.items():
            assert r["home"] == i % 3 and r["nbrs"] == sorted(want[i], key=lambda j: -want[i][j])[: ann.K]
            assert r["sims"] == pytest.approx([want[i][j] for j in r["nbrs"]], abs=1e-5)


def test_a_round_sends_packed_arcs_and_vectors_between_blocks(spark, monkeypatch):
    """Neighbours both ways with their blocks as by hand; no window, no join and no row an arc in a round."""
    frames = []
    monkeypatch.setattr(ann, "written", lambda df, name, write=ann.written: frames.append((name, df, write(df, name))) or frames[-1][2])
    nodes = node_vectors(spark, np.random.default_rng(19).standard_normal((1200, 24)))
    ann.build_graph(nodes, 1200)
    plans = [df._jdf.queryExecution().toString() for name, df, _ in frames if name != "start"]
    assert len(plans) > 4 and not any("Window" in p or "Join" in p or "Generate" in p for p in plans)
    tables = [(name, {r.node: r for r in out.collect()}) for name, _, out in frames if name != "start"]
    block = {u: r.block for u, r in tables[0][1].items()}
    assert len(block) == 1200 and len(set(block.values())) > 1
    for (kind, lists), (_, graph) in zip(tables[1:], tables[2:]):
        if kind == "lists":
            back = collections.defaultdict(list)
            for u, r in lists.items():
                assert r.block == block[u] and list(r.homes) == [block[v] for v in r.nbrs] and u not in r.nbrs and len(set(r.nbrs)) == ann.K
                for v, x in zip(r.nbrs, r.sims):
                    back[v].append((-x, u))
            for u, r in graph.items():
                both = set(lists[u].nbrs) | {v for _, v in sorted(back[u])[: ann.K]}
                assert set(r.both) == both and len(r.both) == len(both) and list(r.places) == [block[v] for v in r.both]
                new = both - set(lists[u].met)
                assert r.fresh == len(new) and set(r.both[len(both) - r.fresh:]) == new


def test_a_hop_scores_each_candidate_once_and_sends_what_beats_the_beam():
    rng = np.random.default_rng(18)
    x, q = _units(rng.standard_normal((200, 16))), _units(rng.standard_normal((5, 16)))
    table = pa.table({"home": [0] * 200, "node": np.arange(200), "vec": pa.array([v.astype(np.float16).tobytes() for v in x])})
    asker, ids, least = rng.integers(0, 5, 900), rng.integers(0, 200, 900), rng.uniform(-0.1, 0.1, 5).astype(np.float32)
    names = [c.split()[0] for c in ann._MAIL.split(", ")]
    rows = [r for a in range(0, 900, 300) for r in ann._mail(1, asker[a: a + 300], ids[a: a + 300], np.arange(1000, 1005), q.astype(np.float16), least)]
    assert len(rows) == 3
    got = collections.defaultdict(list)
    for r in ann._scores_of(2, 8)(ann._packed(rows, names), table).to_pylist():
        for a, i, s in zip(*(np.frombuffer(r[c], k) for c, k in (("asker", np.int64), ("id", np.int64), ("score", np.float32)))):
            assert s == pytest.approx(q[a - 1000] @ x[i], abs=1e-5) and ann._home(np.array([a]), 2)[0] == r["block"]
            got[a - 1000].append(i)
    for a in range(5):
        some = {int(i) for i in ids[asker == a] if q[a] @ x[i] > least[a]}
        assert got[a] == sorted(some, key=lambda i: -(q[a] @ x[i]))[:8]


def test_length_of_a_vector_binds_its_largest_component_once(spark):
    rows = spark.createDataFrame([(1, [3.0, 4.0]), (2, [3e200, -4e200]), (3, [0.0, 5e-200])], "id long, x array<double>")
    assert [r.n for r in rows.select(ann._length(F.col("x")).alias("n")).collect()] == pytest.approx([5.0, 5e200, 5e-200])
    plan = rows.select(ann._length(F.col("x")).alias("n"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_max") == 1


def test_signatures_do_not_depend_on_the_points_held(monkeypatch):
    rng = np.random.default_rng(15)
    doc = np.repeat(np.arange(40), 30)
    element, weight = rng.integers(0, 1 << 44, len(doc)).astype(np.uint64), rng.integers(1, 9, len(doc))
    whole = near_dedup.bag_minhash(doc, element, weight, 40)
    sizes, at = [], near_dedup.np.minimum.at
    monkeypatch.setattr(near_dedup, "POINTS", 500)
    monkeypatch.setattr(near_dedup, "np", Counted(near_dedup.np, lambda first, cell, time: (sizes.append(len(cell)), at(first, cell, time))))
    assert (near_dedup.bag_minhash(doc, element, weight, 40) == whole).all()
    assert len(sizes) > 10 and max(sizes) < 3000  # 500 and what one draw of all shingles gives


class Counted:
    """numpy with another ``minimum.at``."""

    def __init__(self, module, at):
        self._module, self.minimum = module, type("minimum", (), {"at": staticmethod(at)})

    def __getattr__(self, name):
        return getattr(self._module, name)


def test_nearest_neighbours_of_few_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 2.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in ann.nearest(df, F.col("id") % 20 == 0).collect()]
    assert sorted(got) == [(0, 1, 2, 1.0), (0, 2, 1, 0.0)]
    assert ann.nearest(df.limit(0), F.col("id") % 20 == 0).count() == 0
