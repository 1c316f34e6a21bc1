"""Near-duplicate groups by min-max hashing.

Each of ``HASHES`` permutations of the shingle space yields two signature
values, its minimum and its maximum over the document's set, so 288 values
cost 144 evaluations. Both are unbiased for Jaccard similarity and their
estimate has a lower variance than that of as many independent minima. Bands
of ``ROWS`` values propose pairs: at similarity 0.8 a pair is in no common
band with probability (1 - 0.8**6)**48, below 1e-6. One bit per value, 256 in
all, forms a sketch that discards clearly dissimilar candidates (the cut is
six standard deviations below the threshold); what remains is confirmed on
the full shingle sets.

Groups stay distributed whatever their size:

* documents with equal sets are one node, numbered by one of their rows; its
  component is named by the smallest id of all;
* in each band, nodes are first compared with the band's smallest node, not
  with each other (a join on the band, which Spark can split);
* links inside a component that is already found can't change the result, so
  a second round takes only those smallest nodes whose band mates form several
  components, and compares the mates outside the largest one with all others,
  in blocks of bounded size on their full sets; only links leave a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxcast.llm.bpe import chunks, ragged
from rxcast.llm.tables import components, stored

HASHES, ROWS = 144, 6
BANDS = 2 * HASHES // ROWS
#: Of 256 sketch bits, the most that may differ: similarity 0.8 differs in 26 on average.
MOST_BITS = 64
CHUNK_BYTES = 4 << 20
#: Shingles in a block of the second round, and matches counted at once.
LEFT_SHINGLES, RIGHT_SHINGLES, AT_ONCE = 500_000, 2_000_000, 4_000_000
_RNG = np.random.default_rng(20240229)
_ODD = _RNG.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = _RNG.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = _RNG.integers(0, 2**63, HASHES, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all bits depend on all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """Sorted 64-bit hashes of each text's distinct shingles of ``k`` words
    (A-Z in lower case); of fewer words the whole sequence; none: empty."""
    words = [(t or "").encode("utf-8").lower().split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter((h for w in words for h in map(xxhash.xxh3_64_intdigest, w)), np.uint64, int(sizes.sum()))
    padded = np.append(flat, np.zeros(k, np.uint64))
    begin = np.cumsum(sizes) - sizes
    counts = np.where(sizes == 0, 0, np.maximum(1, sizes - k + 1))
    doc = np.repeat(np.arange(len(texts)), counts)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts) + begin[doc]
    used = np.minimum(sizes, k)[doc]
    h = used.astype(np.uint64) * _ODD[0]
    for i in range(k):
        h += np.where(i < used, padded[at + i], np.uint64(0)) * _ODD[1 + i % 63] * np.uint64(2 * (i // 63) + 1)
    h = mix(h)
    ends = np.cumsum(counts)
    return [np.unique(h[e - c:e]) for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Per non-empty set a row of 2 * HASHES values of 32 bits: minimum and
    maximum under each permutation, side by side."""
    flat = np.concatenate(sets)
    first = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), 2 * HASHES), np.uint64)
    for i in range(HASHES):
        v = (flat ^ _XOR[i]) * _MUL[i]
        out[:, 2 * i] = np.minimum.reduceat(v, first)
        out[:, 2 * i + 1] = np.maximum.reduceat(v, first)
    return out >> np.uint64(32)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of ROWS values, its number included."""
    parts = sig.reshape(len(sig), BANDS, ROWS)
    h = np.arange(BANDS, dtype=np.uint64)[None, :] * _ODD[40]
    for r in range(ROWS):
        h = mix(h + parts[:, :, r] * _ODD[41 + r])
    return h.view(np.int64)


def sketch(sig: np.ndarray) -> np.ndarray:
    """Four longs: the lowest bit of the first 256 values."""
    bits = (sig[:, :256] & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits, axis=1).view(np.int64)


def _described(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0), np.int64) + 1
            for a, b in chunks(size, CHUNK_BYTES):
                part = batch.slice(a, b - a)
                sets = shingle_sets(part.column("text").to_pylist(), k)
                n = np.array([len(s) for s in sets], np.int64)
                full = [s for s in sets if len(s)]
                bands, marks = np.zeros((0, BANDS), np.int64), np.zeros((len(sets), 4), np.int64)
                if full:
                    sig = signatures(full)
                    bands, marks[n > 0] = band_keys(sig), sketch(sig)
                upto = np.append(0, np.cumsum(np.where(n > 0, BANDS, 0)))
                keys = pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("hash"), pa.array(n), keys,
                     pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(bands.ravel())),
                     *[pa.array(np.ascontiguousarray(marks[:, i])) for i in range(4)]],
                    names=["id", "hash", "n", "key", "bands", "s0", "s1", "s2", "s3"])
    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0), np.int64) + 1
            for a, b in chunks(size, CHUNK_BYTES):
                part = batch.slice(a, b - a)
                sets = shingle_sets(part.column("text").to_pylist(), k)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "set"])
    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            left, right = batch.column("set_a"), batch.column("set_b")
            for i in range(batch.num_rows):
                a, b = (np.frombuffer(c[i].as_buffer(), np.uint64) for c in (left, right))
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep[i] = 100 * common >= percent * (len(a) + len(b) - common)
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return run


def _crossed(percent: int):
    """Links between the sets of a left and a right block whose components
    differ, by counting matches in the sorted shingles of the right block."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return schema.empty_table()
        (xs, nx, ix, rx), (ys, ny, iy, ry) = ((
            np.frombuffer(b"".join(t["set"].to_pylist()), np.uint64), t["n"].to_numpy(), t["node"].to_numpy(),
            t["root"].to_numpy()) for t in (left, right))
        order = np.argsort(ys, kind="stable")
        ys, owner = ys[order], np.repeat(np.arange(len(ny)), ny)[order]
        first, last = np.searchsorted(ys, xs, "left"), np.searchsorted(ys, xs, "right")
        ends, found = np.cumsum(nx), []
        work = np.add.reduceat(last - first, ends - nx)
        for a, b in chunks(work, AT_ONCE):
            at = slice(ends[a] - nx[a], ends[b - 1])
            hits = owner[ragged(first[at], (last - first)[at])]
            who = np.repeat(np.repeat(np.arange(b - a), nx[a:b]), (last - first)[at])
            common = np.bincount(who * len(ny) + hits, minlength=(b - a) * len(ny)).reshape(b - a, len(ny))
            union = nx[a:b, None] + ny[None, :] - common
            i, j = np.nonzero((100 * common >= percent * union) & (rx[a:b, None] != ry[None, :]))
            found.append((ix[a:b][i], iy[j]))
        one, two = (np.concatenate(c) for c in zip(*found, strict=True))
        return pa.table([pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two))], schema=schema)
    return run


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept, text_hash) per row of ``docs``.

    Documents are linked where 100 * intersection >= ``percent`` * union of
    their shingle sets; ``component_id`` is the smallest id reachable.
    Texts without a word, null ones included, have an empty set and no link.
    Rows with equal id are one document: their texts' sets are linked. A null id takes part with its text
    but never names a group: alone it has a null component and is kept,
    in a group with an id it isn't. Other columns are ignored; an empty table
    gives an empty result."""
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    signed = stored(rows.select("id", "text", F.xxhash64("text").alias("hash")).mapInArrow(
        _described(shingle), "id long, hash long, n long, key binary, bands array<long>, s0 long, s1 long, s2 long, s3 long")
        .withColumn("row", F.monotonically_increasing_id()), "minmax")
    full = signed.where("n > 0 and id is not null")
    # an id may have several texts: a node is a row, so that it has one set
    nodes = stored(full.groupBy("key").agg(F.min("row").alias("node"), F.min("id").alias("name")), "minmax-nodes")
    reps = signed.join(nodes, signed["row"] == nodes["node"], "left_semi")
    marks = reps.select(F.col("row").alias("node"), "n", "s0", "s1", "s2", "s3")
    banded = reps.select(F.col("row").alias("node"), F.explode("bands").alias("band"))
    repeated = stored(full.groupBy("id").agg(F.count("*").alias("of")).where("of > 1").select("id"), "minmax-ids")
    unique = repeated.isEmpty()

    low = banded.groupBy("band").agg(F.min("node").alias("low"), F.count("*").alias("of")).where("of > 1")
    shared = stored(banded.join(low.select("band", "low"), "band").select("low", "node").distinct(), "minmax-bands")
    # both sides of this join follow the input: no switch to a broadcast where they happen to be small
    wanted = reps.select(F.col("row").alias("node"), F.col("id").alias("rep"), "hash").join(shared.select("node").distinct(), "node")
    texts = rows.join(wanted.hint("merge"), F.col("id").eqNullSafe(F.col("rep")) & (F.xxhash64("text") == F.col("hash"))) \
        .select(F.col("node").alias("id"), "text")
    sets = stored((texts if unique else texts.dropDuplicates(["id"]))
                  .mapInArrow(_sets(shingle), "id long, set binary").withColumnRenamed("id", "node"), "minmax-sets")
    found = _confirm(_close(shared.where("node <> low").select(F.col("low").alias("a"), F.col("node").alias("b")), marks, percent),
                     sets, percent)
    if not unique:  # the sets of an id are linked
        held = stored(full.join(repeated, "id", "left_semi").join(nodes, "key").select("id", "node").distinct(), "minmax-held")
        first = held.groupBy("id").agg(F.min("node").alias("a"))
        found = found.union(held.join(first, "id").where("a <> node").select("a", F.col("node").alias("b")))

    roots = components(found)
    rooted = shared.join(roots, "node", "left").select("low", "node", F.coalesce("root", "node").alias("root"))
    open_ = rooted.groupBy("low", "root").agg(F.count("*").alias("of")).groupBy("low") \
        .agg(F.count("*").alias("roots"), F.max_by("root", F.struct("of", "root")).alias("most")).where("roots > 1").select("low", "most")
    rest = stored(rooted.join(open_, "low").join(marks.select("node", "n"), "node"), "minmax-open")
    if not rest.isEmpty():
        parts = rest.groupBy("low").agg(
            F.ceil(F.sum("n") / RIGHT_SHINGLES).alias("ys"),
            F.ceil(F.sum(F.when(F.col("root") != F.col("most"), F.col("n"))) / LEFT_SHINGLES).alias("xs"))
        dealt = rest.join(parts, "low").join(sets, "node")
        place = lambda of: F.pmod(F.xxhash64("node"), of)
        every = lambda of: F.explode(F.sequence(F.lit(0), of - 1).cast("array<bigint>"))
        left = dealt.where("root <> most").withColumn("x", place(F.col("xs"))).withColumn("y", every(F.col("ys")))
        right = dealt.withColumn("y", place(F.col("ys"))).withColumn("x", every(F.col("xs")))
        columns = ("low", "x", "y", "node", "root", "n", "set")
        cut = lambda side: side.select(*columns).toDF(*columns).groupBy("low", "x", "y")
        more = cut(left).cogroup(cut(right)).applyInArrow(_crossed(percent), "a long, b long").distinct()
        roots = components(found.union(more))

    names = nodes.join(roots, "node").groupBy("root").agg(F.min("name").alias("component"))
    grouped = nodes.join(roots.join(names, "root"), "node", "left").select("key", F.coalesce("component", "name").alias("component"))
    return signed.select("id", "hash", "n", "key").join(grouped, "key", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("component", "id")).alias("kept"), F.col("hash").alias("text_hash"))


def _alike(x: str, y: str, percent: int):
    """Sizes allow the threshold and the sketches don't rule it out."""
    n, m = F.col(f"n{x}"), F.col(f"n{y}")
    bits = sum((F.bit_count(F.col(f"s{i}{x}").bitwiseXOR(F.col(f"s{i}{y}"))) for i in range(1, 4)),
               F.bit_count(F.col(f"s0{x}").bitwiseXOR(F.col(f"s0{y}"))))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (bits <= MOST_BITS)


def _close(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    side = lambda s: marks.select(*[F.col(c).alias(f"{c}_{s}") for c in marks.columns])
    return pairs.join(side("a"), F.col("a") == F.col("node_a")).join(side("b"), F.col("b") == F.col("node_b")) \
        .where(_alike("_a", "_b", percent)).select("a", "b")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold, as a written table."""
    side = lambda s: sets.select(F.col("node").alias(s), F.col("set").alias(f"set_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b")
    return stored(both.mapInArrow(_linked(percent), "a long, b long").distinct(), "minmax-links")
