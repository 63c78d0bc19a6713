"""Quality rules against a plain-Python version of the counts and the scoring; constraints, edge cases, held-out accuracy."""

import random
import re

import numpy as np
import pytest
from helpers import EDGES, docs
from hypothesis import given, settings
from hypothesis import strategies as st

from hazardflow.llm import quality_rules as q

SMALL = "/root/testdata/sf0.001"
SIGN = np.array([int(f in q.RISING) for f in q.FEATURES])


def brute(text):
    """The first five counts, by definition."""
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    grams = [tuple(words[i: i + 5]) for i in range(len(words) - 4)]
    hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), sum(x in lines[:i] for i, x in enumerate(lines)), len(hit))


TEXTS = ["", " ", "a b a b a b a b", "x " * 30, "ä# ü * |\x0b<\x0c>\r\n$\n$ \n$", " a  b\x00c \x1f", "one two three four five " * 2,
         "l\nl\n \nl\n", "😀 & 😀 %", "\t\t\n\n"]


@pytest.mark.parametrize("text", TEXTS)
def test_counts(text):
    assert q.statistics(text.encode())[:5] == brute(text)


@given(st.text(alphabet="ab#\n \té|", max_size=60))
@settings(max_examples=300, deadline=None)
def test_counts_of_any_text(text):
    got = q.statistics(text.encode())
    words = re.findall("[^\x20\x09-\x0d]+", text)
    assert got[:5] == brute(text) and got[5] == len(text) and got[10] == len(set(words))


def test_long_texts_in_pieces(monkeypatch):
    rnd = random.Random(5)
    text = " ".join(rnd.choice(("ab", "ä", "c" * 40, "d\ne")) for _ in range(500))
    whole = q.statistics(text.encode())
    monkeypatch.setattr(q, "PIECE", 7)
    assert q.statistics(text.encode()) == whole and whole[:5] == brute(text)


def walked(model, x):
    """Chances by walking each row down each tree."""
    out = []
    for row in x:
        score = model.start
        for at in model.roots:
            for _ in range(model.depth):
                at = model.left[at] + (row[model.feature[at]] > model.threshold[at])
            score += model.value[at]
        out.append(1 / (1 + np.exp(-score)))
    return np.array(out)


def noisy(n=600, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.random((n, len(q.FEATURES)))
    y = (rng.random(n) < 0.15 + 0.7 * ((x[:, 0] + 0.5 * np.sin(9 * x[:, 0]) + x[:, 7]) > 1.1)).astype(float)
    return x, y


def test_flat_arrays_score_like_single_walks():
    x, y = noisy()
    model = q.fit_trees(x, y, np.ones(len(y)), SIGN)
    np.testing.assert_allclose(model.chance(x), walked(model, x), rtol=1e-12)
    assert len(model.roots) == q.TREES and np.mean((model.chance(x) > 0.5) == y) > 0.75
    leaf = np.isinf(model.threshold)
    assert (model.left[leaf] == np.flatnonzero(leaf)).all() and (model.left[~leaf] > np.flatnonzero(~leaf)).all()


@pytest.mark.parametrize("direction", [1, -1])
def test_constraints_hold_on_the_whole_range(direction):
    x, y = noisy()
    sign = np.zeros(len(q.FEATURES), int)
    sign[0] = direction
    model = q.fit_trees(x, y, np.ones(len(y)), sign)
    free = q.fit_trees(x, y, np.ones(len(y)), sign * 0)
    grid = np.linspace(-0.2, 1.2, 200)
    steps = []
    for m in (model, free):
        lines = np.repeat(x[:50], len(grid), axis=0)
        lines[:, 0] = np.tile(grid, 50)
        steps.append(direction * np.diff(m.chance(lines).reshape(50, -1), axis=1))
    assert steps[0].min() >= -1e-12 and steps[1].min() < -1e-3


def test_query_on_the_table_equals_brute_force(spark):
    rows = {r.doc_id: r for r in q.op12_quality_rules(spark, SMALL).collect()}
    table = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect() if r.doc_id in table}
    stats = {i: q.statistics((t or "").encode()) for i, t in table.items()}
    x = q.features(np.array([stats[i] for i in rows]))
    counts, poor, weight = q.training_rows(*(lambda d: (q.document_statistics(d), spark.read.parquet(f"{SMALL}/labels.parquet")))(
        spark.read.parquet(f"{SMALL}/documents.parquet")))
    assert sorted(map(tuple, counts)) == sorted(stats[i] for i in quality) and int(poor.sum()) == sum(v == 0 for v in quality.values())
    chance = dict(zip(rows, walked(q.fit_trees(q.features(counts), poor, weight, SIGN), x)))
    assert set(rows) == set(table)
    for i, r in rows.items():
        n, *_, repeats = base = brute(table[i])
        failed = n < 10 or 100 * repeats > 20 * n
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == failed and abs(r.poor_chance - chance[i]) < 1e-9 and r.kept == (not failed and chance[i] < q.POOR)


def test_held_out_accuracy(spark):
    stats = q.document_statistics(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).persist()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = q.fit_rules(stats, labels.where("doc_id % 2 = 0"))
    held = stats.join(labels.where("doc_id % 2 = 1"), stats["id"] == labels["doc_id"]).toPandas()
    poor = model.chance(q.features(held[q.COUNTS].to_numpy())) >= q.POOR
    assert poor[held.quality == 0].mean() > 0.95 and poor[held.quality == 1].mean() < 0.01
    stats.unpersist()


LABELS = "doc_id long, quality int, toxic int, n_words int, chance double"


@pytest.mark.parametrize("labels", [[], [(1, 1, 0, 3, 0.5)], [(None, 0, 0, 1, 0.1), (4, None, 1, 1, 0.1), (5, 7, 1, 1, 0.1), (7, 0, 0, 1, 0.1)]])
def test_edge_cases_without_labels_of_both_classes(spark, labels):
    df = docs(spark, EDGES)
    got = q.judge(df, spark.createDataFrame(labels, LABELS)).collect()
    want = sorted([(i, *brute(t)) for i, t, *_ in EDGES], key=str)
    assert sorted([tuple(r)[:6] for r in got], key=str) == want
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and r.kept != r.base_failed for r in got)
    assert q.judge(df.limit(0), spark.createDataFrame(labels, LABELS)).count() == 0


def test_documents_labelled_both_ways_count_as_poor_and_hot_ids_stay_in_bounds(spark):
    df = docs(spark, [(1, "a b c")] * 50 + [(2, "d e f")])
    labels = spark.createDataFrame([(1, 1, 0, 1, 0.1), (1, 0, 0, 1, 0.1), (2, 1, 0, 1, 0.1)], LABELS)
    _, poor, weight = q.training_rows(q.document_statistics(df), labels)
    assert len(poor) == 51 and poor.sum() == 50 and abs(weight[poor == 1].sum() - weight[poor == 0].sum()) < 1e-9
    assert len(q.training_rows(q.document_statistics(df), labels, sample=3)[0]) == 6
