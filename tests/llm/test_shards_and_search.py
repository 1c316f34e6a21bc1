import itertools
import zlib

import numpy as np
from llm_fixtures import SF_CHECK, no_documents, odd_documents  # noqa: F401
from pyspark.sql import functions as F

from rxcast.llm import hilbert
from rxcast.llm.hilbert import curve_index, hilbert_shards
from rxcast.llm.onebit import encode, estimates, nearest, rotation


def test_curve_visits_every_cell_in_steps_of_one(spark):
    cells = spark.range(65536).select(*[F.shiftright("id", 4 * (3 - i)).bitwiseAND(15).cast("int").alias(f"x{i}") for i in range(4)])
    rows = sorted((r.c, (r.x0, r.x1, r.x2, r.x3)) for r in cells.withColumn("c", curve_index("x0", "x1", "x2", "x3")).collect())
    assert [c for c, _ in rows] == list(range(65536))
    assert all(sum(abs(a - b) for a, b in zip(p, q, strict=True)) == 1 for (_, p), (_, q) in itertools.pairwise(rows))


def check(rows, n):
    size = len(rows)
    for s in range(n):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots))) and abs(len(slots) - size / n) < 1
    along = [r.curve for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert along == sorted(along)


def test_rows_law_on_whole_table_and_with_many_slices(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    rows = hilbert_shards(docs, 16).collect()
    check(rows, 16)
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert all(r.size == len(texts[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) for r in rows)
    monkeypatch.setattr(hilbert, "SLICE_ROWS", 10)  # the same order whatever the slices
    again = hilbert_shards(docs.repartition(5), 16).collect()
    assert {r.doc_id: (r.shard, r.slot) for r in again} == {r.doc_id: (r.shard, r.slot) for r in rows}


def test_odd_rows(spark, odd_documents, no_documents):  # noqa: F811
    rows = hilbert_shards(odd_documents, 4).collect()
    assert len(rows) == 15
    check(rows, 4)
    assert all(r.size == 1 and r.text_crc32 == 0 for r in rows if r.doc_id in (3, 4))
    assert hilbert_shards(no_documents, 4).count() == 0


def brute(ids, x, k, every):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = np.zeros(len(x))
        for d in range(x.shape[1]):
            s += x[:, d] * x[i, d]
        near = np.flatnonzero(ids != ids[i])
        near = near[np.lexsort((ids[near], -s[near]))][:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in near]
    return out


def found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_on_whole_table(spark):
    table = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet")
    rows = table.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float32).astype(float)
    got, want = found(nearest(table).collect()), brute(ids, x, 20, 20)
    assert got.keys() == want.keys()
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.99 * sum(map(len, want.values()))
    assert got == want


def test_ties_duplicates_and_vectors_that_take_no_part(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.normal(size=5).round(1)], "x") for i in range(120)]
    rows += [(i, [1.0, 0.0, 0.0, 0.0, 0.0], "same") for i in range(200, 260)]
    bad = [(300, None, ""), (301, [0.0] * 5, ""), (302, [1.0, None, 0.0, 0.0, 0.0], ""), (303, [float("nan")] * 5, ""),
           (304, [float("inf"), 0.0, 0.0, 0.0, 0.0], ""), (305, [1.0, 2.0], ""), (None, [9.0] * 5, ""), (306, [], "")]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, score string").repartition(6)
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float32).astype(float)
    assert found(nearest(table, 7, 20).collect()) == brute(ids, x, 7, 20)
    assert nearest(table.limit(0)).count() == 0
    few = table.where("vec_id in (200, 201, 20)")
    assert {q: len(v) for q, v in found(nearest(few, 20, 20).collect()).items()} == {20: 2, 200: 2}


def test_estimates_are_within_their_bounds():
    rng = np.random.default_rng(5)
    x, q, turn = rng.normal(size=(2000, 64)), rng.normal(size=(20, 64)), rotation(64)
    centre = x.mean(axis=0)
    guess, error = estimates(*encode(x, centre, turn), q, centre, turn)
    off = np.abs(guess - q @ x.T)
    assert (off <= error).mean() > 0.999 and abs((guess - q @ x.T).mean()) < 0.2 and np.allclose(turn @ turn.T, np.eye(64))


def test_rows_of_one_id_spread_over_slices(spark, monkeypatch):
    monkeypatch.setattr(hilbert, "SLICE_ROWS", 10)
    kept = []
    monkeypatch.setattr(hilbert, "stored", lambda df, name: kept.append(df) or df)
    ids = [None] * 100 + [5] * 100 + list(range(100))
    docs = spark.createDataFrame([(i, f"text {k}", "en", "s") for k, i in enumerate(ids)], "doc_id long, text string, lang string, source string")
    rows = hilbert_shards(docs, 4).collect()
    check(rows, 4)
    largest = kept[0].groupBy("cell", "slice").count().agg(F.max("count")).first()[0]
    assert largest < 40
