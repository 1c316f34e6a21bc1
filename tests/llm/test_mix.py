from collections import defaultdict

import numpy as np
from llm_fixtures import SF_CHECK, no_documents, odd_documents  # noqa: F401

from rxcast.llm.cube import balanced_mix, flight, land, settle_largest


def targets(sizes: dict) -> dict:
    """The rule as stated: share by weight, cap, reshare until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(3 * sizes[s] for s in capped)
        t = {s: 3 * sizes[s] if s in capped else rest * weight[s] / sum(weight[x] for x in free) for s in names}
        over = {s for s in free if t[s] > 3 * sizes[s]}
        if not over:
            return t
        capped |= over


def test_targets_totals_and_reruns(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    rows = balanced_mix(docs).collect()
    sizes, taken, want = defaultdict(int), defaultdict(int), {}
    text = {r.doc_id: len((r.text or "").encode().split()) for r in docs.collect()}
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        want[r.source] = r.target
        assert r.size == text[r.doc_id] and r.taken == r.copies * r.size <= 3 * r.size
    rule = targets(sizes)
    assert all(abs(rule[s] - want[s]) < 1e-6 for s in rule)
    assert all(abs(taken[s] - want[s]) < 0.05 * want[s] for s in rule)
    again = {r.doc_id: r.copies for r in balanced_mix(docs.repartition(7)).collect()}
    assert again == {r.doc_id: r.copies for r in rows}


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(5)
    x, p = rng.lognormal(5, 1.5, 3000).round(), rng.random(3000)
    q = flight(settle_largest(p.copy(), x, rng), x, rng)
    assert ((q > 0) & (q < 1)).sum() <= 2
    assert abs((q * x).sum() - (p * x).sum()) < 1e-3 * (p * x).sum() / 100 and abs(q.sum() - p.sum()) < 1e-3
    assert set(np.unique(land(q, x))) <= {0.0, 1.0}


def test_probabilities_are_kept_on_average():
    x, p = np.array([1.0, 2, 3, 4, 50]), np.array([0.2, 0.4, 0.6, 0.8, 0.5])
    mean = np.mean([flight(p.copy(), x, np.random.default_rng(s)) for s in range(3000)], axis=0)
    assert np.abs(mean - p).max() < 0.05


def test_odd_rows(spark, odd_documents, no_documents):
    rows = balanced_mix(odd_documents).collect()
    assert len(rows) == 15
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
    rule = targets(sizes)
    assert all(abs(rule[r.source] - r.target) < 1e-6 and r.source_size == sizes[r.source] for r in rows)
    assert all(r.taken == 0 for r in rows if r.doc_id in (3, 4, 5))
    assert balanced_mix(no_documents).count() == 0
