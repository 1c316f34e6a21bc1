"""Periodic runs of words by multi-scale minimizers.

A run is a stretch of words with smallest period q and length of at least
``max(shortest, times * q)`` that no neighbouring word extends. The texts of a
chunk sit in one flat array of word numbers, a number of its own between two
texts, so that no run leaves its text.

* Periods up to ``SHORT`` are scanned directly: the places where a word equals
  the one q further on, in stretches.
* Longer ones go by scales: periods above P / 2 and up to P, for P = 16, 32...
  The grams of P words are hashed (each scale doubles the last), and the least
  hash of every window of P / 2 grams marks a minimizer. Inside a run a window
  and the one a period further on are equal, so their minimizers are equal
  grams at distance q; as a gram is no shorter than the period and the period
  is the smallest, no equal gram stands between them. Neighbours among equal
  minimizers are the seeds; those of one distance that touch are one cluster.
* A cluster is compared word by word, and P / 2 places beyond either end, where
  a run of at least 4 periods must end, or a nearer minimizer had been a seed.

A scale marks about 4 / P of the words and its clusters read a few words for
each, so the work is linear in the words per scale; texts too short for a scale
leave the array. Hashes have 64 bits and choose seeds only; what is reported
was compared on words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rxcast.llm.bpe import chunks, ragged
from rxcast.llm.tables import WORD

SHORT = 8
CHUNK_BYTES = 1 << 20
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix (two multiply-xorshift rounds) of unsigned numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def doubled(h: np.ndarray, m: int) -> np.ndarray:
    """Hashes of grams of 2m words from those of m; a gram that the array's
    end cuts is like no other."""
    out = mixed(np.arange(len(h), dtype=np.uint64) + np.uint64(1 << 63))
    if len(h) > m:
        out[:-m] = mixed(h[:-m] * np.uint64(3) + mixed(h[m:]))
    return out


def extremes(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Least or greatest of every window of ``width`` (a power of two)."""
    step = 1
    while step < width:
        x = pick(x[:-step], x[step:])
        step *= 2
    return x


def minimizers(h: np.ndarray, width: int) -> np.ndarray:
    """Places that are the least of some window (all of them on a tie)."""
    if len(h) < width:
        return np.zeros(0, np.int64)
    low = extremes(h, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    # the greatest minimum among the windows over a place is its own hash only if it is one of them
    return np.flatnonzero(extremes(np.concatenate([edge, low, edge]), width, np.maximum) == h)


def stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], equal.view(np.int8), [0]])))
    return edges[::2], edges[1::2]


@cache
def primes(q: int) -> tuple[int, ...]:
    """Prime factors of q."""
    out, p = [], 2
    while p * p <= q:
        if q % p == 0:
            out.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return (*out, q) if q > 1 else tuple(out)


def smallest(a: np.ndarray, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether no divisor of the period is one as well: of a stretch of two
    periods and more, any smaller period divides it."""
    case = [(i, q // p) for i, q in enumerate(period.tolist()) for p in primes(q)]
    ok = np.ones(len(start), bool)
    if case:
        i, d = np.array(case, np.int64).T
        size = period[i] - d
        at = ragged(start[i], size)
        same = a[at] == a[at + np.repeat(d, size)]
        ok[i[np.logical_and.reduceat(same, np.cumsum(size) - size)]] = False
    return ok


def seeds(h: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of neighbours among equal minimizers, for distances
    in the scale's range, by distance and place."""
    at = minimizers(h, scale // 2)
    at = at[np.argsort(h[at], kind="stable")]
    twin = h[at[:-1]] == h[at[1:]]
    place, gap = at[:-1][twin], np.diff(at)[twin]
    fits = (gap > scale // 2) & (gap <= scale)
    place, gap = place[fits], gap[fits]
    order = np.lexsort((place, gap))
    return place[order], gap[order]


def extended(a: np.ndarray, place: np.ndarray, gap: np.ndarray, scale: int, times: int) -> tuple[np.ndarray, ...]:
    """(start, length, period) of the runs that the seeds lie in."""
    if not len(place):
        return place, place, place
    fresh = np.append(True, (np.diff(gap) != 0) | (np.diff(place) > scale))
    first, last = np.flatnonzero(fresh), np.append(np.flatnonzero(fresh)[1:], len(place)) - 1
    q = gap[first]
    low = np.maximum(place[first] - scale // 2 - 1, 0)
    high = np.minimum(place[last] + scale + scale // 2 + 1, len(a) - q)
    size = high - low
    at = ragged(low, size)
    ends = np.cumsum(size)
    equal = a[at] == a[at + np.repeat(q, size)]
    equal[ends - 1] = False  # a stretch up to the edge is longer than a run may be here
    s, e = stretches(equal)
    of = np.searchsorted(ends, s, "right")
    inner = (s > ends[of] - size[of]) & (e - s >= (times - 1) * q[of])
    s, e, of = s[inner], e[inner], of[inner]
    return at[s], e - s + q[of], q[of]


def find_runs(ids: np.ndarray, sizes: np.ndarray, shortest: int = 6, times: int = 4) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of all runs by text, start and period.
    ``ids`` are the word numbers (0 and up) of texts of ``sizes`` words;
    ``times`` is 4 or more, as the scales need."""
    assert times >= 4
    n = len(sizes)
    first = np.cumsum(sizes) - sizes + np.arange(n) + 1  # a separator before each text and one at the end
    a = -1 - np.arange(len(ids) + n + 1, dtype=np.int64)
    a[ragged(first, sizes)] = ids
    found = []
    for q in range(1, SHORT + 1):
        s, e = stretches(a[q:] == a[:-q])
        long = e - s + q >= max(shortest, times * q)
        s, e = s[long], e[long]
        found.append((s, e - s + q, np.full(len(s), q, np.int64), smallest(a, s, np.full(len(s), q, np.int64))))

    origin, text = np.arange(len(a)), np.repeat(np.arange(n), sizes + 1)
    text = np.append(text, n)  # a text and the separator before it; the last one is of no text
    h, scale = mixed(a.astype(np.uint64)), 1
    longest = int(sizes.max(initial=0))
    while times * (scale + 1) <= longest:  # the next scale begins at periods of scale + 1
        h = doubled(h, scale)
        scale *= 2
        if scale <= SHORT:
            continue
        stays = np.append(sizes >= times * (scale // 2 + 1), True)[text]
        if not stays.all():
            a, h, origin, text = a[stays], h[stays], origin[stays], text[stays]
        s, length, q = extended(a, *seeds(h, scale), scale, times)
        long = length >= np.maximum(shortest, times * q)
        s, length, q = s[long], length[long], q[long]
        found.append((origin[s], length, q, smallest(a, s, q)))
    s, length, q, ok = (np.concatenate(x) for x in zip(*found, strict=True))
    runs = np.unique(np.stack([s[ok], q[ok], length[ok]]), axis=1)
    of = np.searchsorted(first, runs[0], "right") - 1
    return of, runs[0] - first[of], runs[2], runs[1]


def collapse(words: list[str], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> str:
    """The words less those of a run beyond its first period."""
    if not len(start):
        return " ".join(words)
    turn = np.zeros(len(words) + 1, np.int64)
    np.add.at(turn, start + period, 1)
    np.add.at(turn, start + length, -1)
    gone = np.cumsum(turn) > 0
    return " ".join([w for w, g in zip(words, gone.tolist(), strict=False) if not g])


def periodic_runs(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), shortest: int = 6,
                  times: int = 4) -> DataFrame:
    """``keep`` columns, n_words, runs (array of start, length, period, by
    start and period) and the collapsed text of each row.

    A null or empty text has no words, no runs and collapses to an empty text.
    Rows are independent, so null ids and repeated rows need no rule; runs that
    overlap are all reported. Other columns of ``docs`` are ignored; an empty
    table gives an empty result. A task holds about ``CHUNK_BYTES`` of texts at
    once, or one longer text."""
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = re.compile(WORD).findall
        for batch in batches:
            bytes_ = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column("__text")), 0), np.int64) + 1
            for i, j in chunks(bytes_, CHUNK_BYTES):
                part = batch.slice(i, j - i)
                words = [split(t or "") for t in part.column("__text").to_pylist()]
                sizes = np.array([len(w) for w in words], np.int64)
                ids = pd.factorize(np.array([*chain.from_iterable(words)], object))[0].astype(np.int64)
                of, start, length, period = find_runs(ids, sizes, shortest, times)
                cut = np.searchsorted(of, np.arange(len(words) + 1))
                left = [collapse(w, start[x:y], length[x:y], period[x:y])
                        for w, x, y in zip(words, cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
                runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in names] + [pa.array(sizes), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), runs), pa.array(left, pa.string())],
                    names=[*names, "n_words", "runs", "collapsed"])

    schema = T.StructType([docs.schema[c] for c in names] + [
        T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    return docs.select(*names, docs[text_col].alias("__text")).mapInArrow(run, schema)
