"""Quality classifier by positive-unlabelled learning.

Trusted positives are the documents labelled 1 in the learning folds; all
documents together, labels unseen, are the unlabelled web text. Rows labelled 0
play no part. The class prior is estimated from both sets: a first g, of prior
one half, orders all documents, and no share ``pi`` of positives can exceed
U(g >= t) / P(g >= t), the ratio of what lies above a cut among all documents
and among positives; the least ratio over the cuts is the prior. As a g rates
its own positives too high, each half of them (by a hash of the id) has a g,
and the positives of one half are counted with the other half's. With the squared loss
l(z) = (1 - z)^2 / 4 the unbiased risk of a linear g,

    prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)]),

needs only first and second moments of the inputs over positives and over all
documents: one distributed pass sums them, and the driver minimises on
matrices whose size the features fix. The risk is the larger of two convex
quadratics (with the second term and without it). Where the minimum of the
first drives that term below zero, the least risk is the minimum of a mean of
both, weighted so that the term is zero; the weight is found by bisection. The
minimiser orders documents; the score is the posterior that follows from the
same two sets, prior * P(g) / U(g) per hundredth of g, made monotone, as the
mean over both g.

Inputs are statistics of the whole text (lengths, kinds of characters,
repetition, lines), each cut at quantiles of the corpus into steps, so g is an
additive function of any shape. Nothing else of a document is read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxcast.llm.bpe import chunks
from rxcast.llm.labelled import clear_labels, fold, monotone
from rxcast.llm.tables import stored

#: Characters counted together, per word.
GROUPS = (b"!", b"?", b"|", b"$%&*#", b".", b",", b":;", b"\"'()[]{}", b"<>=/\\_@~^+`", b"-")
#: Corpus quantiles at which a statistic steps.
CUTS = (0.02, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.98)
STATISTICS = 19 + len(GROUPS)
CHUNK_BYTES, MOMENT_ROWS, RIDGE = 4 << 20, 200_000, 1e-4
#: Least share of the positives above a cut that the prior is read from.
KEPT = 0.3
#: Added ridge per positive, as few positives leave the weights loose.
SHRINK = 3.0
_UPPER, _LOWER, _DIGIT = (np.array([chr(c) in s for c in range(256)]) for s in (
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"))


def statistics(text: bytes) -> list[float]:
    """The statistics of one text; all 0 without a word."""
    words = text.split()
    if not words:
        return [0.0] * STATISTICS
    n, size = len(words), len(text)
    of = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper, lower, digits = (int(of[x].sum()) for x in (_UPPER, _LOWER, _DIGIT))
    share = of[of > 0] / size
    lens = np.fromiter(map(len, words), np.int64, n)
    pairs = max(n - 1, 1)
    lines = [x for x in text.split(b"\n") if x.strip()]
    common = Counter(words).most_common(1)[0][1]
    return [np.log1p(size), np.log1p(n), lens.mean(), lens.std(), float(lens.max()), upper / max(upper + lower, 1),
            upper / n, digits / size, int(of[128:].sum()) / size, len(set(words)) / n, len(set(words)) / n**0.7, common / n,
            len(set(zip(words, words[1:], strict=False))) / pairs, np.log1p(len(lines)), n / len(lines),
            len(set(lines)) / len(lines), float((share * np.log(share)).sum()), (lens <= 3).mean(), (lens > 12).mean(),
            *[int(of[list(g)].sum()) / n for g in GROUPS]]


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0), np.int64) + 1
        for a, b in chunks(size, CHUNK_BYTES):
            part = batch.slice(a, b - a)
            x = np.array([statistics((t or "").encode("utf-8")) for t in part.column("text").to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("key"), pa.FixedSizeListArray.from_arrays(
                pa.array(x.ravel()), STATISTICS).cast(pa.list_(pa.float64()))], names=["id", "key", "x"])


def steps(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """A column of ones, then for each statistic whether it is above each edge."""
    return np.concatenate([np.ones((len(x), 1))] + [x[:, [i]] > e for i, e in enumerate(edges)], axis=1).astype(np.float64)


def _moments(edges: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            z = steps(batch.column("x").flatten().to_numpy().reshape(-1, STATISTICS), edges)
            half = batch.column("half").to_numpy()
            both = np.stack([z.T @ z, *(z[half == h].T @ z[half == h] for h in (0, 1))])
            total = both if total is None else total + both
        if total is not None:
            i, j = np.triu_indices(total.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *map(pa.array, total[:, i, j])],
                                             names=["i", "j", "u", "p0", "p1"])
    return run


def minimise(p: np.ndarray, u: np.ndarray, prior: float, ridge: float = RIDGE) -> np.ndarray:
    """Weights of least non-negative risk from the second moments of positives
    and of all documents; row 0 of a moment matrix is the mean."""
    def at(share: float) -> np.ndarray:
        return np.linalg.solve(prior * (1 - share) * p + share * u + ridge * np.eye(len(u)), prior * (1 + share) * p[0] - share * u[0])

    rest = lambda w: (1 + 2 * u[0] @ w + w @ u @ w) - prior * (1 + 2 * p[0] @ w + w @ p @ w)
    w = at(1.0)
    if rest(w) >= 0:
        return w
    low, high = 0.0, 1.0
    for _ in range(50):
        mid = (low + high) / 2
        low, high = (low, mid) if rest(at(mid)) < 0 else (mid, high)
    return at(low)


JUDGED = "id long, key long, half int, g0 double, g1 double"


def _judged(edges: list[np.ndarray], weights: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = steps(batch.column("x").flatten().to_numpy().reshape(-1, STATISTICS), edges)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("id", "key", "half")] + [
                pa.array(np.clip(z @ w, -2, 2)) for w in weights], names=["id", "key", "half", "g0", "g1"])
    return run


def _bins(judged: DataFrame):
    """Mean g, all documents and positives per hundredth of g (401 rows at
    most), both g of a document counted but where it was one of its positives."""
    each = judged.select("half", F.posexplode(F.array("g0", "g1")).alias("of", "g")).where("half is null or half <> of")
    return each.groupBy(F.floor(F.col("g") * 100).alias("bin")).agg(
        F.avg("g").alias("g"), F.count("*").alias("u"), F.count("half").alias("p")).orderBy("bin").toPandas()


def class_prior(u: np.ndarray, p: np.ndarray) -> float:
    """Least ratio of the shares of all documents and of positives above a cut;
    the counts are per bin of g, ascending."""
    above_u, above_p = (np.cumsum(x[::-1]) / x.sum() for x in (u, p))
    cuts = above_p >= KEPT
    return float(np.clip((above_u[cuts] / above_p[cuts]).min(), 0.01, 0.99))


def posterior(u: np.ndarray, p: np.ndarray, prior: float) -> np.ndarray:
    """prior * P / U per bin of g, made monotone, 1 at most."""
    return np.minimum(1.0, monotone(u, p * (prior * u.sum() / p.sum())))


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, threshold: float = 0.3,
                   id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(id, held_out, score, predicted, text_hash) per row of ``docs``.

    Labels count only where CRC-32 of the id as text modulo ``folds`` isn't
    ``held_out``. ``predicted`` is 1 from ``threshold`` on. A null text is
    empty; an empty one has all statistics 0 and gets a score as well; a null
    id has no label and isn't held out; conflicting labels of an id don't
    count. Rows that repeat an id are scored each. Without positive labels in
    both halves of the learning folds every score is 1 (nothing is rejected); an empty table
    gives an empty result. Other columns are never read."""
    rows = docs.select(docs[id_col].cast("long").alias("id"), F.xxhash64(docs[text_col]).alias("key"), docs[text_col].alias("text"))
    described = stored(rows.mapInArrow(_described, "id long, key long, x array<double>"), "quality")
    good = stored(clear_labels(labels, id_col, label_col).where((F.col("label") == 1) & (fold(F.col("id"), folds) != held_out))
                  .select("id", F.pmod(F.xxhash64("id"), F.lit(2)).cast("int").alias("half")), "quality-positives")
    mine = F.coalesce(fold(F.col("id"), folds) == held_out, F.lit(False))
    n, weights = described.count(), None
    marked = described.join(good, "id", "left").select("id", "key", "x", "half")
    if n and not good.isEmpty():
        cuts = described.agg(*[F.percentile_approx(F.get("x", F.lit(i)), list(CUTS), 1000) for i in range(STATISTICS)]).first()
        edges = [np.unique(c) for c in cuts]
        schema = "i int, j int, u double, p0 double, p1 double"
        sums = marked.select("x", F.coalesce("half", F.lit(-1)).alias("half")).coalesce(max(8, -(-n // MOMENT_ROWS))) \
            .mapInArrow(_moments(edges), schema).groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("u", "p0", "p1")]) \
            .toPandas()  # the size is the features' alone
        u, *halves = (np.zeros((int(sums["i"].max()) + 1,) * 2) for _ in range(3))
        for m, c in zip((u, *halves), ("u", "p0", "p1"), strict=True):
            m[sums["i"], sums["j"]] = m[sums["j"], sums["i"]] = sums[c]
        if all(h[0, 0] for h in halves):
            fit = lambda prior: [minimise(h / h[0, 0], u / u[0, 0], prior, RIDGE + SHRINK / h[0, 0]) for h in halves]
            first = _bins(marked.mapInArrow(_judged(edges, fit(0.5)), JUDGED))
            prior = class_prior(first["u"].to_numpy(float), first["p"].to_numpy(float))
            weights = fit(prior)
    if weights is None:
        scored = described.select("id", "key", mine.alias("held_out"), F.lit(1.0).alias("score"))
    else:
        judged = stored(marked.mapInArrow(_judged(edges, weights), JUDGED), "quality-g")
        bins = _bins(judged)
        at, shares = bins["g"].to_numpy(), posterior(bins["u"].to_numpy(float), bins["p"].to_numpy(float), prior)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                value = sum(0.999 * np.interp(g, at, shares) + 0.001 * (g + 2) / 4 for g in (
                    b.column("g0").to_numpy(), b.column("g1").to_numpy())) / 2
                yield pa.RecordBatch.from_arrays([b.column(c) for c in ("id", "key", "held_out")] + [pa.array(np.clip(value, 0, 1))],
                                                 names=["id", "key", "held_out", "score"])

        scored = judged.select("id", "key", mine.alias("held_out"), "g0", "g1").mapInArrow(
            score, "id long, key long, held_out boolean, score double")
    return scored.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
                         F.col("key").alias("text_hash"))
