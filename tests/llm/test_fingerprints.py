import zlib

import numpy as np
from llm_fixtures import SF_CHECK, no_documents, odd_documents  # noqa: F401
from pyspark.sql import functions as F

from rxcast.llm import iblt
from rxcast.llm.iblt import CELLS, edited, fingerprint_edits, likeness, paragraphs, peel, range_of, sketches


def exact(a: str, b: str) -> float:
    """Likeness from the digests themselves."""
    (x, nx), (y, ny) = (paragraphs([t]) for t in (a, b))
    total = int(nx[0] + ny[0])
    return 1.0 if not total else 1 - len(set(x.tolist()) ^ set(y.tolist())) / total


def test_peeling_recovers_the_difference():
    rng = np.random.default_rng(2)
    common, own, other = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (500, 3, 4))
    sides = [np.concatenate([common, x]) for x in (own, other)]
    (c1, k1, x1), (c2, k2, x2) = (sketches(s, np.zeros(len(s), np.int64), 1, CELLS) for s in sides)
    found, whole = peel(c1 - c2, k1 ^ k2, x1 ^ x2, 1, CELLS)
    assert whole[0] and found[0] == 7


def test_likeness_is_exact_after_retries():
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 900, n)) for n in (1, 5, 40, 3000, 3000)]
    texts += [texts[3][:-200], "", " ", "a\na\na", "a\na"]
    pairs = [(a, b) for a in texts for b in texts]
    (p, np_), (q, nq) = (paragraphs([x[i] for x in pairs]) for i in (0, 1))
    assert np.allclose(likeness(p, np_, q, nq), [exact(a, b) for a, b in pairs])


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    texts = [r.text or "" for r in docs.orderBy("doc_id").collect()]
    got = fingerprint_edits(docs).orderBy("doc_id").collect()
    assert len(got) == len(texts)
    for i, r in enumerate(got):
        after = texts[(i + 1) % len(texts)]
        assert r.n_chars == len(texts[i]) and r.edited == edited(texts[i], after)
        assert abs(r.near_edited - exact(texts[i], r.edited)) < 1e-9 and abs(r.near_next - exact(texts[i], after)) < 1e-9
    prints = {}
    for t, r in zip(texts, got, strict=True):
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
    assert np.mean([r.near_edited for r in got]) > 0.6 > 0.1 > np.mean([r.near_next for r in got])


def test_odd_rows(spark, odd_documents, no_documents):
    rows = fingerprint_edits(odd_documents).collect()
    assert len(rows) == 15
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[3].n_chars == 0 and by[3].edited == "" and by[3].near_edited == 1.0 and by[3].near_next == 1.0
    assert by[0].fingerprint == by[1].fingerprint and by[0].near_next == 1.0
    assert by[11].edited.endswith("no id here at all"[:len(by[11].edited) // 4][-5:])
    one = fingerprint_edits(odd_documents.where("doc_id = 8")).first()
    assert one.edited == "one" and one.near_next == 1.0
    assert fingerprint_edits(no_documents).count() == 0


def test_ranges_count_the_cuts_below(spark):
    cuts = list(range(0, 1000, 7))
    got = [r[0] for r in spark.range(-5, 1010).select(range_of(F.col("id"), cuts)).collect()]
    assert got == [sum(c < i for c in cuts) for i in range(-5, 1010)]


def test_edit_is_the_stated_one():
    t, o = "abcdefghij", "XYZ"
    assert edited(t, o) == "abcdefghXY" and edited("abcdefghijklmnopqrst", o) == "abcdefghijklmnoXYZ"


def test_rows_without_an_id_or_with_one_id_are_cut_by_their_texts(spark, monkeypatch):
    monkeypatch.setattr(iblt, "RANGE_ROWS", 20)
    ids = [None] * 150 + [7] * 100 + [6, 8, 9] + list(range(100, 250))
    texts = [f"word{i * 7919 % 1009} of text {i}" for i in range(len(ids))]
    rows = list(zip(ids, texts, strict=True)) + [(7, texts[160])] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32(r[1].encode()), r[1]))
    want = sorted((str(i), t, ordered[(k + 1) % len(ordered)][1]) for k, (i, t) in enumerate(ordered))
    found = iblt.with_next(docs, "doc_id", "text")
    assert sorted((str(r.id), r.text, r.next) for r in found.collect()) == want
    monkeypatch.setattr(iblt, "BROADCAST_RANGES", 0)
    assert sorted((str(r.id), r.text, r.next) for r in iblt.with_next(docs, "doc_id", "text").collect()) == want
