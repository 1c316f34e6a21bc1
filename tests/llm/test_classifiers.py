import time
import zlib

import numpy as np
import pytest
from llm_fixtures import SF_CHECK, labels, no_documents, odd_documents  # noqa: F401
from pyspark.sql import functions as F

from rxcast.llm.labelled import monotone
from rxcast.llm.puquality import STATISTICS, class_prior, minimise, posterior, quality_scores, statistics
from rxcast.llm.toxic import beginnings, decay, segments, toxicity_scores


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for s in np.unique(score):
        rank[score == s] = rank[score == s].mean()
    n1 = label.sum()
    return (rank[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(label) - n1))


@pytest.mark.parametrize("scores, column, folds, out, least", [(quality_scores, "quality", 5, 0, 0.95), (toxicity_scores, "toxic", 4, 2, 0.8)])
def test_held_out_accuracy_and_folds(spark, scores, column, folds, out, least):
    docs, known = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: r for r in scores(docs, known).collect()}
    assert len(rows) == docs.count()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % folds == out)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(rows[r.doc_id].score, r[column]) for r in known.collect() if rows[r.doc_id].held_out]
    score, label = np.array([x[0] for x in held]), np.array([x[1] for x in held])
    assert auc(score, label) >= least
    assert (((score >= 0.3) == label).mean()) >= 0.9


@pytest.mark.parametrize("scores, column", [(quality_scores, "quality"), (toxicity_scores, "toxic")])
def test_held_out_labels_and_other_columns_are_never_read(spark, scores, column):
    docs, known = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    folds, out = (5, 0) if column == "quality" else (4, 2)
    flipped = known.withColumn(column, F.when(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % folds == out, 1 - F.col(column)).otherwise(F.col(column)))
    bare = docs.select("doc_id", "text")
    a, b = ({r.doc_id: r.score for r in scores(d, k).collect()} for d, k in ((docs, known), (bare, flipped)))
    assert a == b


@pytest.mark.parametrize("scores", [quality_scores, toxicity_scores])
def test_odd_rows(spark, scores, odd_documents, no_documents, labels):  # noqa: F811
    rows = scores(odd_documents, labels).collect()
    assert len(rows) == 15 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    assert all(not r.held_out for r in rows if r.doc_id is None)
    same = {r.score for r in rows if r.doc_id in (3, 4, 5)}
    assert len(same) == 1  # no words, null text: one score
    assert scores(no_documents, labels).count() == 0
    none = scores(odd_documents, labels.limit(0)).collect()
    assert len(none) == 15 and len({r.score for r in none}) == 1


def test_statistics_of_odd_texts():
    assert statistics(b"") == statistics(b" \n") == [0.0] * STATISTICS
    assert all(np.isfinite(statistics(t)).all() and len(statistics(t)) == STATISTICS for t in (b"a", b"a b\n\nc", "é".encode() * 9999))


def test_risk_is_corrected_where_the_second_term_turns_negative():
    rng = np.random.default_rng(0)
    x = np.concatenate([np.ones((60, 1)), rng.integers(0, 2, (60, 40))], axis=1).astype(float)
    u, p = x.T @ x / 60, x[:12].T @ x[:12] / 12
    w = minimise(p, u, 0.7)
    free = np.linalg.solve(u + 1e-4 * np.eye(41), 2 * 0.7 * p[0] - u[0])
    risk = lambda w: 0.7 * (1 - 2 * p[0] @ w + w @ p @ w) / 4 + max(0.0, (1 + 2 * u[0] @ w + w @ u @ w) / 4 - 0.7 * (1 + 2 * p[0] @ w + w @ p @ w) / 4)
    assert risk(w) <= risk(np.zeros(41)) and np.isfinite(w).all() and len(free) == len(w)


def brute_segments(x):
    """Maximal scoring subsequences by their recursive definition."""
    best = None
    for i in range(len(x)):
        for j in range(i, len(x)):
            s = sum(x[i:j + 1])
            if s > 1e-12 and (best is None or s > best[2] + 1e-9 or (abs(s - best[2]) <= 1e-9 and j - i < best[1] - best[0])):
                best = (i, j, s)
    if best is None:
        return []
    i, j, s = best
    left, right = brute_segments(x[:i]), brute_segments(x[j + 1:])
    return left + [(i, j, s)] + [(a + j + 1, b + j + 1, t) for a, b, t in right]


def test_segments_equal_the_definition():
    rng = np.random.default_rng(8)
    for _ in range(200):
        n, cost = int(rng.integers(1, 14)), 0.37
        hit = rng.random(n) < 0.4
        score = rng.random(n) * 2 + 0.05
        x = np.where(hit, score, -cost).tolist()
        got = segments(np.flatnonzero(hit), score[hit], cost)
        want = brute_segments(x)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_parts_of_the_score():
    assert beginnings("achlichung") == ["achlichung", "achlichun", "achlichu", "achlich", "achlic", "achli", "achl"]
    assert beginnings("abc") == ["abc"]
    rates, scores = np.array([0.01, 0.02]), np.array([3.0, 2.0])
    x = decay(rates, scores, 0.1)
    assert abs((rates * np.exp(x * scores)).sum() + 0.97 * np.exp(-x * 0.1) - 1) < 1e-6
    assert monotone(np.array([2.0, 2, 2, 4]), np.array([0.0, 2, 1, 4])).tolist() == [0, 0.75, 0.75, 1]


def test_minimum_of_the_corrected_risk_against_a_direct_search():
    rng = np.random.default_rng(4)
    corrected = 0
    for _ in range(6):
        x = np.concatenate([np.ones((200, 1)), rng.normal(size=(200, 1))], axis=1)
        x[:60, 1] += rng.uniform(0, 4)
        prior = rng.uniform(0.3, 0.95)
        u, p = x.T @ x / 200, x[:60].T @ x[:60] / 60

        def risk(w, p=p, u=u, prior=prior):
            e = lambda m, s: (1 + 2 * s * (m[0] @ w) + w @ m @ w) / 4
            return prior * e(p, -1) + max(0.0, e(u, 1) - prior * e(p, 1)) + 1e-4 * w @ w / 4

        w = minimise(p, u, prior)
        free = np.linalg.solve(u + 1e-4 * np.eye(2), 2 * prior * p[0] - u[0])
        corrected += not np.allclose(w, free)
        grid = min(risk(np.array([a, b])) for a in np.linspace(-2, 2, 161) for b in np.linspace(-2, 2, 161))
        assert risk(w) <= grid + 1e-6
    assert corrected >= 1  # the corrected branch was taken


def test_prior_and_posterior_of_a_known_mixture():
    rng = np.random.default_rng(6)
    good = np.histogram(np.clip(rng.normal(0.6, 0.2, 60_000), -1, 1), 100, (-1, 1))[0]
    bad = np.histogram(np.clip(rng.normal(-0.4, 0.2, 40_000), -1, 1), 100, (-1, 1))[0]
    trusted = np.histogram(np.clip(rng.normal(0.6, 0.2, 5_000), -1, 1), 100, (-1, 1))[0]
    prior = class_prior((good + bad).astype(float), trusted.astype(float))
    assert abs(prior - 0.6) < 0.03
    both = (good + bad) > 0
    got = posterior((good + bad)[both].astype(float), trusted[both].astype(float), prior)
    assert (np.diff(got) >= 0).all() and got.max() <= 1
    assert abs(np.average(got, weights=(good + bad)[both]) - 0.6) < 0.05


def test_negative_labels_play_no_part_in_quality(spark):
    docs, known = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    a, b = ({r.doc_id: r.score for r in quality_scores(docs, k).collect()} for k in (known, known.where("quality = 1")))
    assert a == b


def test_scan_is_linear_where_every_hit_lies_below_the_last():
    at = np.arange(200_000) * 1000
    began = time.monotonic()
    found = segments(at, np.ones(len(at)), 0.5)
    assert [f[:2] for f in found[:2]] == [(0, 0), (1000, 1000)] and len(found) == len(at)
    assert time.monotonic() - began < 20  # hours, if each hit passed all earlier ones
