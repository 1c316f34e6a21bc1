import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from llm_fixtures import SF_CHECK, no_documents, odd_documents  # noqa: F401

from rxcast.llm.periodic import find_runs, periodic_runs
from rxcast.llm.queries import QUERIES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, shortest=6, times=4):
    """Every lag and every stretch; a stretch of two periods is primitive unless a smaller lag fills it."""
    found = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(shortest, times * q) and not any(w[s:i + q - d] == w[s + d:i + q] for d in range(1, q)):
                found.append((s, i - s + q, q))
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    w = planted(doc_id, WORDS.findall(text or ""))
    runs = brute(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_whole_table_against_every_lag(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()}
    short = {i: t for i, t in docs.items() if len(t or "") < 2500}
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_minimizer_runs"](spark, SF_CHECK).collect()}
    assert got.keys() == docs.keys() and sum(g[0] for g in got.values()) > 50
    assert {i: got[i] for i in short} == {i: expected(i, t) for i, t in short.items()}
    for i in docs.keys() - short.keys():  # the brute force takes minutes over these: all periods of the planted part, and no run lost
        words = planted(i, WORDS.findall(docs[i]))
        ids = {w: k for k, w in enumerate(dict.fromkeys(words))}
        a = np.array([ids[w] for w in words])
        runs = 0
        for q in range(1, len(a) // 4 + 1):
            edges = np.flatnonzero(np.diff(np.concatenate([[0], (a[q:] == a[:-q]).astype(int), [0]])))
            for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                if e - s + q >= max(6, 4 * q):
                    runs += not any(words[s:e + q - d] == words[s + d:e + q] for d in range(1, q))
        assert got[i][0] == runs


def test_random_words_of_many_periods():
    rng = random.Random(3)
    for _ in range(150):
        docs = []
        for _ in range(rng.randint(1, 4)):
            w = []
            while rng.random() < 0.8:
                u = [rng.randrange(rng.choice([1, 2, 2, 3, 10])) for _ in range(rng.choice([1, 2, 3, 5, 8, 9, 12, 16, 17, 33, 40]))]
                w += (u * rng.randint(1, 8))[:rng.randint(1, 8 * len(u))]
            docs.append(w)
        of, *runs = find_runs(np.array([x for d in docs for x in d], np.int64), np.array([len(d) for d in docs], np.int64))
        got = list(zip(*(x.tolist() for x in (of, *runs)), strict=True))
        assert got == [(k, *r) for k, d in enumerate(docs) for r in brute(d)]


def test_long_periods_and_long_runs():
    rng = np.random.default_rng(2)
    unit, other = rng.integers(0, 400, 7001), rng.integers(0, 400, 30000)
    a = np.concatenate([other, np.tile(unit, 5), other[:100], np.zeros(200_000, np.int64)])
    of, start, length, period = (x.tolist() for x in find_runs(a, np.array([len(a)])))
    runs = {(s, q): n for s, n, q in zip(start, length, period, strict=True)}
    assert any(abs(s - 30000) < 3 and q == 7001 and 35005 <= n < 35010 for (s, q), n in runs.items())
    assert any(q == 1 and n >= 200_000 for (_, q), n in runs.items()) and set(of) == {0} and len(runs) == 2


def test_odd_rows(spark, odd_documents, no_documents):
    rows = periodic_runs(odd_documents.withColumnRenamed("ids", "runs_"), keep=("doc_id", "source")).collect()
    texts = sorted((r.text or "") for r in odd_documents.collect())
    assert sorted(r.collapsed for r in rows) == sorted(" ".join(WORDS.findall(t)) for t in texts) and all(r.runs == [] for r in rows)
    repeated = spark.createDataFrame([(None, "a b " * 5), (None, "a b " * 5), (7, "x " * 6), (8, "x " * 5), (9, "a a a a a a b " * 4)], "doc_id long, text string")
    got = sorted((r.collapsed, [tuple(x) for x in r.runs]) for r in periodic_runs(repeated).collect())
    assert got == [("a b", [(0, 6, 1), (0, 28, 7), (7, 6, 1), (14, 6, 1), (21, 6, 1)]), ("a b", [(0, 10, 2)]), ("a b", [(0, 10, 2)]),
                   ("x", [(0, 6, 1)]), ("x x x x x", [])]
    assert periodic_runs(no_documents).count() == 0
