"""Toxicity by maximum-scoring segments.

Tokens are words and their beginnings of ``STEM`` characters and more, so an
insult is known in all its endings. They get log-odds of toxic against clean
labelled text under a Dirichlet prior (both together, ``PRIOR`` tokens
strong). Whether a token is significant is judged on the number of documents
with it (signed root of the likelihood ratio), as a text repeats its words and
token counts would call the habits of single documents significant. Tokens well and significantly on the toxic
side form the lexicon; a word scores as its longest beginning there, and
every other word costs a little: the log-odds of a word outside the lexicon.

A linear scan per text finds all maximal segments of positive score; between
two hits the cost is the gap's, so the scan steps over hits only. Segment
scores of random clean text follow an extreme-value law: with its parameters
(lambda from the clean rates, K from the segments of clean labelled
documents), a segment of score S in a text of N words is expected
K N exp(-lambda S) times. A document's evidence is the sum over its
significant segments of lambda S - ln(K N), and the share of toxic documents
among the labelled ones of such evidence, made monotone, is the score.
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

#: Shortest and longest proper beginning of a word, strength of the prior in tokens, least root and log-odds.
STEM, LONGEST, PRIOR, LEAST_ROOT, LEAST_ODDS = 4, 12, 2000.0, 4.5, 1.5
EDGES = ".,!?;:\"'()[]{}<>*_-"
CHUNK_BYTES, FLUSH = 4 << 20, 200_000
NAMES = ("docs0", "docs1", "tokens0", "tokens1")


def words(text: str | None) -> list[str]:
    """Words in lower case without punctuation at their ends."""
    return [w.strip(EDGES) for w in (text or "").lower().split()]


def beginnings(word: str) -> list[str]:
    """The word and its beginnings, longest first."""
    return [word, *(word[:k] for k in range(min(len(word) - 1, LONGEST), STEM - 1, -1))]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[str, list[int]] = {}  # documents and tokens, clean then toxic

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string())] + [
            pa.array([c[i] for c in seen.values()], pa.int64()) for i in range(4)], names=["token", *NAMES])
        seen.clear()
        return out

    for batch in batches:
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0), np.int64) + 1
        for a, b in chunks(size, CHUNK_BYTES):
            part = batch.slice(a, b - a)
            for text, label in zip(part.column("text").to_pylist(), part.column("label").to_pylist(), strict=True):
                own: Counter[str] = Counter()
                for w, n in Counter(words(text)).items():
                    for t in beginnings(w):
                        own[t] += n
                for t, n in own.items():
                    c = seen.setdefault(t, [0, 0, 0, 0])
                    c[label] += 1
                    c[2 + label] += n
                if len(seen) > FLUSH:
                    yield flush()
    yield flush()


def segments(at: np.ndarray, score: np.ndarray, cost: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first token, last token, score) where
    tokens ``at`` score ``score`` and each other token ``-cost``: Ruzzo and
    Tompa's scan, a stack of candidates with their sums left and right and the
    place of the last one below with a smaller left sum. The search follows
    these places, so none is passed twice and the scan is linear."""
    stack: list[tuple[int, int, float, float, int]] = []  # first, last, sum before, sum including, place
    total, after = 0.0, -1
    for i, s in zip(at.tolist(), score.tolist(), strict=True):
        total -= cost * (i - after - 1) if after >= 0 else 0.0
        first, left, right, k = i, total, total + s, len(stack) - 1
        total, after = right, i
        while k >= 0 and stack[k][2] >= left:
            k = stack[k][4]
        while k >= 0 and stack[k][3] < right:
            first, _, left, _, below = stack[k]
            del stack[k:]
            k = below
        stack.append((first, i, left, right, k))
    return [(a, b, r - l) for a, b, l, r, _ in stack]


def _scanned(lexicon: dict[str, float], cost: float):
    starts = {t[:STEM] for t in lexicon}
    score = lambda w: next((lexicon[t] for t in beginnings(w) if t in lexicon), None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("segments", pa.list_(pa.struct(
            [("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())])))])
        for batch in batches:
            size = np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0), np.int64) + 1
            for a, b in chunks(size, CHUNK_BYTES):
                part, ns, found = batch.slice(a, b - a), [], []
                for text in part.column("text").to_pylist():
                    own = words(text)
                    hits = [(i, s) for i, w in enumerate(own) if w[:STEM] in starts and (s := score(w)) is not None]
                    ns.append(len(own))
                    found.append([{"first": x, "last": y, "score": s} for x, y, s in segments(
                        np.array([h[0] for h in hits]), np.array([h[1] for h in hits]), cost)] if hits else [])
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(ns, pa.int64()), pa.array(found, schema.field(2).type)],
                                                 schema=schema)
    return run


def decay(rates: np.ndarray, scores: np.ndarray, cost: float) -> float:
    """lambda > 0 with sum of rate * exp(lambda * score) = 1 over all tokens."""
    rest = 1 - rates.sum()
    f = lambda x: (rates * np.exp(x * scores)).sum() + rest * np.exp(-x * cost) - 1
    low, high = 0.0, 1.0
    while f(high) < 0 and high < 64:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return max(high, 1e-3)


def toxicity_scores(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, threshold: float = 0.3,
                    most_labelled: int = 40_000, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic") -> DataFrame:
    """(id, held_out, score, predicted, segments) per row of ``docs``;
    ``segments`` lists the passages with positive score (first and last token,
    score).

    Labels count only where CRC-32 of the id as text modulo ``folds`` isn't
    ``held_out``; token counts come from about ``most_labelled`` of them,
    chosen by hash. The lexicon holds all of their significant tokens: each is
    in several of these documents, so that sample bounds it. A null or empty text has no segment and the score of documents
    without evidence; a null id has no label and isn't held out; conflicting
    labels of an id don't count. Rows that repeat an id are scored each.
    Without toxic and clean learning rows every score is 0; an empty table
    gives an empty result. Other columns are never read."""
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    mine = F.coalesce(fold(F.col("id"), folds) == held_out, F.lit(False))
    known = stored(clear_labels(labels, id_col, label_col).where(fold(F.col("id"), folds) != held_out), "toxic-labels")
    share = min(1.0, most_labelled / max(1, known.count()))
    sample = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20)))  # its size is bounded
    counts = stored(rows.join(F.broadcast(sample), "id").select("text", "label").mapInArrow(
        _counted, "token string, " + ", ".join(f"{c} long" for c in NAMES)).groupBy("token")
        .agg(*[F.sum(c).alias(c) for c in NAMES]).where("token <> '' and docs1 > 0"), "toxic-counts")
    n0, n1, t0, t1 = (float(x or 0) for x in rows.join(F.broadcast(sample), "id").withColumn(
        "n", F.size(F.split("text", r"\s+"))).agg(F.sum(1 - F.col("label")), F.sum("label"), F.sum((1 - F.col("label")) * F.col("n")),
                                                F.sum(F.col("label") * F.col("n"))).first())
    lexicon, rates, cost = {}, np.zeros(0), 1.0
    if n0 and n1 and t0 > 0 and t1 > 0:
        prior = PRIOR * (F.col("tokens0") + F.col("tokens1") + 1) / (t0 + t1 + 2)
        a, b = F.col("tokens0") + prior, F.col("tokens1") + prior
        odds = F.log(b / F.greatest(F.lit(0.5), t1 + PRIOR - b)) - F.log(a / F.greatest(F.lit(0.5), t0 + PRIOR - a))

        def part(seen, expected):
            return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))

        both, none = F.col("docs0") + F.col("docs1"), n0 + n1 - F.col("docs0") - F.col("docs1")
        ratio = sum((part(seen, group * side / (n0 + n1)) for seen, group, side in (
            (F.col("docs1"), n1, both), (F.col("docs0"), n0, both), (n1 - F.col("docs1"), n1, none), (n0 - F.col("docs0"), n0, none))), F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(0.0), 2 * ratio)) * F.signum(F.col("docs1") * n0 - F.col("docs0") * n1)
        top = counts.select("token", "tokens0", "tokens1", odds.alias("odds"), root.alias("root")) \
            .where((F.col("root") >= LEAST_ROOT) & (F.col("odds") >= LEAST_ODDS)).orderBy(F.desc("root"), "token").collect()
        lexicon = {r["token"]: float(r["odds"]) for r in top}
        whole = [r for r in top if not any(t in lexicon for t in beginnings(r["token"])[1:])]  # others are counted with their beginnings
        rates = np.array([(r["tokens0"] + 0.5) / (t0 + 1) for r in whole])
        rate = max(2 * rates.sum(), sum(r["tokens1"] for r in whole) / t1)
        cost = float(-np.log((1 - min(rate, 0.9)) / (1 - min(rates.sum(), 0.4)))) if whole else 1.0
    scanned = stored(rows.mapInArrow(_scanned(lexicon, cost), "id long, n long, segments array<struct<first:int,last:int,score:double>>"), "toxic")
    scores = np.array([lexicon[r["token"]] for r in whole]) if lexicon else np.zeros(0)
    rate_of_decay = decay(rates, scores, cost) if len(scores) else 1.0
    least = float(scores.min()) if len(scores) else 1.0
    clean = scanned.join(known.where("label = 0"), "id").agg(
        F.sum(F.size(F.filter("segments", lambda s: s["score"] >= least))), F.sum("n")).first()
    chance = ((clean[0] or 0) + 1) / ((clean[1] or 0) + 1) * float(np.exp(rate_of_decay * least))  # K
    beyond = F.transform("segments", lambda s: rate_of_decay * s["score"] - F.log(chance * F.greatest("n", F.lit(1))))
    evidence = F.aggregate(beyond, F.lit(0.0), lambda t, e: t + F.greatest(e, F.lit(0.0)))
    best = F.coalesce(F.array_max(beyond), F.lit(-30.0))
    judged = scanned.withColumn("evidence", F.round(F.when(F.size("segments") == 0, -30.0).when(best > 0, evidence).otherwise(best), 1)) \
        .withColumn("evidence", F.greatest(F.lit(-30.0), "evidence"))
    table = judged.join(known, "id").groupBy(F.least(F.lit(200.0), "evidence").alias("evidence")).agg(F.count("*").alias("n"), F.sum("label").alias("hits")) \
        .orderBy("evidence").toPandas()  # 2,301 values at most
    if len(table):
        x = table["evidence"].to_numpy()
        shares = monotone(table["n"].to_numpy(float), table["hits"].to_numpy(float))
    else:
        x, shares = np.zeros(1), np.zeros(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            e = b.column("evidence").to_numpy()
            score = np.clip(0.999 * np.interp(e, x, shares) + 0.001 * (e + 30) / (e + 260), 0, 1) if len(lexicon) else np.zeros(len(e))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("held_out"), pa.array(score), b.column("segments")],
                                             names=["id", "held_out", "score", "segments"])

    scored = judged.select("id", mine.alias("held_out"), "evidence", "segments").mapInArrow(
        run, "id long, held_out boolean, score double, segments array<struct<first:int,last:int,score:double>>")
    return scored.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "segments")
