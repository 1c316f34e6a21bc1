"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text's paragraphs are its lines, long ones cut where the hash of a word
says so (``CUT`` words on average), so an edit disturbs only the paragraphs
that it touches. Each paragraph's 64-bit digest (with its repeat number, so
equal paragraphs stay apart) goes to three cells, one in each third of the
sketch; a cell holds a count, the XOR of its digests and the XOR of their
check hashes.

Two fingerprints are compared by subtracting cells: common paragraphs cancel
and peeling pure cells recovers the digests that only one side has, in rounds
over all pairs of a batch at once. Where the difference is too large for the
sketch, the peeling stalls and the pair is tried again with four times the
cells. Likeness is 1 - differing / (paragraphs of both); two texts without a
word are alike.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rxcast.llm.bpe import chunks, ragged
from rxcast.llm.minmax import mix
from rxcast.llm.tables import partitions_for

#: Cells of a published fingerprint (three thirds), growth per retry, words per cut.
CELLS, GROW, CUT = 24, 4, 4
CHUNK_BYTES, RANGE_ROWS = 4 << 20, 20_000
#: Ranges up to which their first keys are broadcast: four numbers each.
BROADCAST_RANGES = 200_000
_SEED = [np.uint64(0x9E3779B97F4A7C15 * i % 2**64 | 1) for i in (1, 3, 5, 7)]


def paragraphs(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Digests of every text's paragraphs, and how many each text has."""
    hashes, lines, counts = [], [], []
    for t in texts:
        n = 0
        for line in t.encode("utf-8").split(b"\n"):
            if words := line.split():
                hashes += map(xxhash.xxh3_64_intdigest, words)
                lines.append(len(words))
                n += len(words)
        counts.append(n)
    h = np.array(hashes, np.uint64)
    doc = np.repeat(np.arange(len(texts)), counts)
    if not len(h):
        return h, np.zeros(len(texts), np.int64)
    first = np.zeros(len(h), bool)
    first[np.cumsum([0, *lines[:-1]])] = True
    first[1:] |= mix(h[:-1]) % np.uint64(CUT) == 0
    start = np.flatnonzero(first)
    place = np.arange(len(h)) - np.repeat(start, np.diff(np.append(start, len(h))))
    digest = mix(np.add.reduceat(mix(h + place.astype(np.uint64) * _SEED[3]), start))
    doc = doc[start]
    order = np.lexsort((digest, doc))
    d, o = digest[order], doc[order]
    fresh = np.append(True, (d[1:] != d[:-1]) | (o[1:] != o[:-1]))
    at = np.flatnonzero(fresh)
    repeat = np.arange(len(d)) - np.repeat(at, np.diff(np.append(at, len(d))))
    return mix(d + repeat.astype(np.uint64) * _SEED[2]), np.bincount(o, minlength=len(texts))


def cells_of(digest: np.ndarray, cells: int) -> np.ndarray:
    """The three cells of each digest, one in each third."""
    third = cells // 3
    return np.stack([(mix(digest ^ _SEED[i]) % np.uint64(third)).astype(np.int64) + i * third for i in range(3)])


def check_of(digest: np.ndarray) -> np.ndarray:
    return mix(digest * _SEED[1] + _SEED[2])


def toggled(table: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    np.bitwise_xor.at(table, at, values)


def sketches(digest: np.ndarray, owner: np.ndarray, n: int, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, digest XORs and check XORs of ``n`` sketches, flat."""
    at = (cells_of(digest, cells) + owner * cells).ravel()
    count = np.bincount(at, minlength=n * cells).astype(np.int64)
    key, check = np.zeros(n * cells, np.uint64), np.zeros(n * cells, np.uint64)
    toggled(key, at, np.tile(digest, 3))
    toggled(check, at, np.tile(check_of(digest), 3))
    return count, key, check


def peel(count: np.ndarray, key: np.ndarray, check: np.ndarray, n: int, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Digests recovered from each of ``n`` subtracted sketches, and whether
    each came out empty."""
    found = np.zeros(n, np.int64)
    live = np.arange(len(count))
    for _ in range(cells + 1):
        pure = live[(np.abs(count[live]) == 1) & (check[live] == check_of(key[live]))]
        if not len(pure):
            break
        owner, digest, sign = pure // cells, key[pure], count[pure]
        _, once = np.unique(digest + mix(owner.astype(np.uint64)), return_index=True)
        owner, digest, sign = owner[once], digest[once], sign[once]
        found += np.bincount(owner, minlength=n)
        at = (cells_of(digest, cells) + owner * cells).ravel()
        np.subtract.at(count, at, np.tile(sign, 3))
        toggled(key, at, np.tile(digest, 3))
        toggled(check, at, np.tile(check_of(digest), 3))
        live = np.unique(at)
    left = (count != 0) | (key != 0)
    return found, ~left.reshape(n, cells).any(axis=1)


def likeness(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Likeness of the i-th text of each side from their paragraph digests."""
    out = np.ones(len(na))
    owner_a, owner_b = np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)
    pending, cells = np.flatnonzero(na + nb > 0), CELLS
    while len(pending):
        place = np.full(len(na), -1)
        place[pending] = np.arange(len(pending))
        sides = [(d[place[o] >= 0], place[o][place[o] >= 0]) for d, o in ((a, owner_a), (b, owner_b))]
        (ca, ka, xa), (cb, kb, xb) = (sketches(d, o, len(pending), cells) for d, o in sides)
        found, whole = peel(ca - cb, ka ^ kb, xa ^ xb, len(pending), cells)
        done = pending[whole]
        out[done] = 1 - found[whole] / (na[done] + nb[done])
        pending, cells = pending[~whole], cells * GROW
    return out


def fingerprints(digest: np.ndarray, sizes: np.ndarray, cells: int = CELLS) -> list[str]:
    """Each text's sketch as base64: paragraphs, then counts, digest XORs and
    check XORs (32 bits) of the cells."""
    n = len(sizes)
    count, key, check = sketches(digest, np.repeat(np.arange(n), sizes), n, cells)
    rows = np.concatenate([sizes.astype("<u4").view(np.uint8).reshape(n, 4),
                           count.astype("<u4").view(np.uint8).reshape(n, -1),
                           key.astype("<u8").view(np.uint8).reshape(n, -1),
                           (check >> np.uint64(32)).astype("<u4").view(np.uint8).reshape(n, -1)], axis=1) if n else []
    return [base64.b64encode(r.tobytes()).decode() for r in rows]


def edited(text: str, other: str) -> str:
    """The last quarter of ``text`` gives way to as much of ``other``'s start."""
    k = len(text) // 4
    return text[:len(text) - k] + other[:k]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = sum(np.asarray(pc.fill_null(pc.binary_length(batch.column(c)), 0), np.int64) for c in ("text", "next")) + 1
        for a, b in chunks(size, CHUNK_BYTES):
            part = batch.slice(a, b - a)
            own, after = ([t or "" for t in part.column(c).to_pylist()] for c in ("text", "next"))
            new = [edited(t, o) for t, o in zip(own, after, strict=True)]
            known = {t: i for i, t in enumerate(dict.fromkeys(own + after))}
            digest, sizes = paragraphs(list(known))
            start = np.cumsum(sizes) - sizes
            (p, np_), (r, nr) = ((digest[ragged(start[at], sizes[at])], sizes[at]) for at in (
                np.array([known[t] for t in side], np.int64) for side in (own, after)))
            q, nq = paragraphs(new)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([len(t) for t in own], pa.int64()), pa.array(new, pa.string()),
                 pa.array(fingerprints(p, np_)), pa.array(fingerprints(q, nq)),
                 pa.array(likeness(p, np_, q, nq)), pa.array(likeness(p, np_, r, nr))],
                names=["id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def range_of(value, cuts: list[int]):
    """Number of sorted ``cuts`` below ``value``, found in two steps of about
    the square root of their number."""
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts)) + 1
    groups = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    below = lambda xs, v: F.array_size(F.filter(xs, lambda c: c < v))
    group = below(F.lit([g[-1] for g in groups]).cast("array<bigint>"), value)
    fine = F.get(F.lit(groups).cast("array<array<bigint>>"), group)
    return F.coalesce(F.least(group * step + F.coalesce(below(fine, value), F.lit(0)), F.lit(len(cuts))), F.lit(0))


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, next): each row's successor text in ascending id, the first
    row's after the last. One shuffle of the texts by id range; an id that
    more than ``RANGE_ROWS`` rows share, or that as many rows lack, is cut into
    ranges of the texts' CRC. The successor across a range's end is the first
    row of the next one, looked up by its id and CRC."""
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text")) \
        .withColumn("crc", F.crc32(F.encode("text", "UTF-8")))
    n = partitions_for(docs.count(), RANGE_ROWS, spark)
    cuts = sorted({int(c) for c in rows.approxQuantile("id", [i / n for i in range(1, n)], 1 / (4 * n))}) if n > 1 else []
    # at most one id per RANGE_ROWS rows
    parts = {r.id: -(-r.n // RANGE_ROWS) for r in rows.groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") > RANGE_ROWS).collect()}
    shared = sorted(i for i in parts if i is not None)
    cuts = sorted({*cuts, *(c for i in shared for c in (i - 1, i))})  # such an id is a range of its own
    many = F.when(F.col("id").isNull(), F.lit(parts.get(None, 1)))
    if shared:
        at = F.array_position(F.lit(shared).cast("array<bigint>"), F.col("id")).cast("int")
        many = many.when(at > 0, F.get(F.lit([parts[i] for i in shared]), at - 1))
    ranged = rows.withColumn("range", F.struct(
        F.when(F.col("id").isNull(), -1).otherwise(range_of(F.col("id"), cuts)).cast("long").alias("at"),
        F.shiftright(F.col("crc") * many.otherwise(F.lit(1)), 32).alias("part")))
    order = Window.partitionBy("range").orderBy(F.col("id").asc_nulls_first(), "crc", "text")
    inside = ranged.withColumn("next", F.lead("text").over(order)).drop("crc")
    low = ranged.groupBy("range").agg(F.min(F.struct(F.col("id").isNotNull().alias("has"), "id", "crc")).alias("low"))
    ring = Window.orderBy("range")  # four numbers per range
    after = low.select("range", F.coalesce(F.lead("low").over(ring), F.first("low").over(ring)).alias("low")) \
        .select("range", F.col("low.id").alias("low_id"), F.col("low.crc").alias("low_crc"))
    few = len(cuts) + 2 + sum(parts.values()) <= BROADCAST_RANGES
    firsts = rows.join(F.broadcast(after) if few else after.hint("merge"),
                       F.col("id").eqNullSafe(F.col("low_id")) & (F.col("crc") == F.col("low_crc"))) \
        .groupBy("range").agg(F.min("text").alias("first"))
    return inside.join(firsts, "range").select("id", "text", F.coalesce("next", "first").alias("next"))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited, fingerprint, edited_fingerprint, near_edited,
    near_next) per row: the text with its last quarter replaced by the start
    of the next row's text (ascending id, nulls first; equal ids by text; the
    first follows the last), both fingerprints, and the likeness of the text
    to its edited form and to the next row's text. A null text is empty; a
    single row is its own successor; an empty table gives an empty result.
    Other columns are ignored."""
    return with_next(docs, id_col, text_col).mapInArrow(
        _compared, "id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double").withColumnRenamed("id", id_col)
