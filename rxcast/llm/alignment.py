"""Alignment of two tokenizers by merge-path partitioning.

A cuts the bytes of a text into tokens one way, B another. The ends of A's and
of B's tokens, over all texts of a chunk, are two ascending arrays; merging
them walks a path through their grid. The path is divided on equally spaced
diagonals: on diagonal k a binary search finds how many of the k least ends
are A's (all diagonals at once). Between two diagonals lies a piece with the
same number of ends, whatever the texts' lengths, merged on its own: it emits
the overlaps (A token, B token), one for each distinct end. A diagonal may
part an A end from the B end that equals it, and pieces end inside a group;
so the pieces' borders are stitched: a B end that equals the last A end before
its piece adds no overlap but closes the group there.

Where both ends fall together a group closes. The two tokens that close it are
a link. Links are counted by id pair over all texts: a chunk has a dictionary
of its pairs, the dictionaries are aggregated, and the counts return to their
chunks; a pair that very many chunks hold returns by a broadcast of bounded
size. What a task holds follows the chunk's size (or one longer text's).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxcast.llm.bpe import Encoder, chunks, load_vocabulary, ragged
from rxcast.llm.tables import stored

CHUNK_BYTES = 1 << 20
#: Ends that a piece of the path merges.
PIECE = 1 << 16
#: Pairs above a ten-thousandth of all chunk entries, at most so many, are broadcast.
HOT_PAIRS = 10_000


class Cutter:
    """A tokenizer as the engine sees it: ids of a batch of texts in one array
    with the number that each text has, and the bytes of every id."""

    def __init__(self, cut: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], data: np.ndarray, sizes: np.ndarray):
        self.cut, self.bytes, self.sizes = cut, data, sizes
        self.n, self.starts = len(sizes), np.cumsum(sizes) - sizes


def byte_level(vocabulary: dict) -> Cutter:
    """A byte-level BPE vocabulary (see ``load_vocabulary``), given space +
    text; the strings of special tokens are ordinary text."""
    encoder = Encoder(vocabulary | {"special": {}})

    def cut(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = encoder.encode([" " + t for t in texts])
        return ids.astype(np.int64), counts
    return Cutter(cut, vocabulary["bytes"], vocabulary["sizes"])


def piece_level(file: bytes) -> Cutter:
    """A sentencepiece model, which puts the space before the text itself."""
    import sentencepiece
    s = sentencepiece.SentencePieceProcessor(model_proto=file)
    names = s.id_to_piece(list(range(s.get_piece_size())))
    pieces = [bytes([int(p[3:5], 16)]) if s.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]

    def cut(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = s.encode(texts, num_threads=1)
        counts = np.array([len(x) for x in found], np.int64)
        return np.fromiter(chain.from_iterable(found), np.int64, int(counts.sum())), counts
    return Cutter(cut, np.frombuffer(b"".join(pieces), np.uint8), np.array([len(p) for p in pieces], np.int64))


def same_bytes(cutter: Cutter, ids: np.ndarray, counts: np.ndarray, want: bytes, sizes: np.ndarray) -> np.ndarray:
    """Per text, whether its tokens' bytes are its stretch of ``want``."""
    lens = cutter.sizes[ids]
    upto, ends = np.append(0, np.cumsum(lens)), np.cumsum(counts)
    ok = upto[ends] - upto[ends - counts] == sizes
    token_ok = np.repeat(ok, counts)
    got = cutter.bytes[ragged(cutter.starts[ids[token_ok]], lens[token_ok])]
    mine = sizes[ok]
    differ = got != np.frombuffer(want, np.uint8)[ragged((np.cumsum(sizes) - sizes)[ok], mine)]
    wrong = np.add.reduceat(np.append(differ, False), np.minimum(np.cumsum(mine) - mine, len(differ))) if len(mine) else mine
    ok[np.flatnonzero(ok)[(wrong > 0) & (mine > 0)]] = False
    return ok


def path_cuts(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): how many ends of A and of B lie before every ``piece``-th
    diagonal of the merge path, where A goes first among equals."""
    k = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(k - len(b), 0), np.minimum(k, len(a))
    while (low < high).any():  # the least i with a[i] > b[k - i - 1]
        open_ = low < high
        mid = (low + high) // 2
        before = np.zeros(len(k), bool)
        before[open_] = a[mid[open_]] <= b[k[open_] - mid[open_] - 1]
        low, high = np.where(open_ & before, mid + 1, low), np.where(open_ & ~before, mid, high)
    return low, k - low


def merged_piece(a: np.ndarray, b: np.ndarray, i: int, j: int, i_end: int, j_end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlaps of the piece: (A token, B token, both end here) by end. The
    A token of an end is the first that ends there or later, as is B's."""
    ends = np.sort(np.concatenate([a[i:i_end], b[j:j_end]]), kind="stable")  # linear in two ascending runs
    ends = ends[np.append(True, ends[1:] != ends[:-1])] if len(ends) else ends
    if i and j < j_end and len(ends) and b[j] == a[i - 1]:
        ends = ends[1:]  # emitted with the A end before the diagonal
    at_a = i + np.searchsorted(a[i:i_end], ends)
    at_b = j + np.searchsorted(b[j:j_end], ends)
    ends_a = a[np.minimum(at_a, len(a) - 1)] == ends
    ends_b = b[np.minimum(at_b, len(b) - 1)] == ends  # of a B end beyond the diagonal, too: the stitch
    return at_a, at_b, ends_a & ends_b


def overlaps(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All overlaps by end, from pieces that are merged independently."""
    i, j = path_cuts(a, b, piece)
    parts = [merged_piece(a, b, *x) for x in zip(i[:-1].tolist(), j[:-1].tolist(), i[1:].tolist(), j[1:].tolist(), strict=True)]
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(bool)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def spelled(ids: list[np.ndarray], closes: list[np.ndarray], names: list[np.ndarray]) -> np.ndarray:
    """Strings of A's and B's tokens in the order of their groups, A before B,
    each with the mark that follows: , within, | after A's, ; after B's."""
    group = [np.cumsum(np.append(0, c[:-1])) if len(c) else np.zeros(0, np.int64) for c in (x.astype(np.int64) for x in closes)]
    order = np.argsort(np.concatenate([2 * group[0], 2 * group[1] + 1]), kind="stable")
    return np.concatenate([names[s][2 * ids[s] + closes[s]] for s in (0, 1)])[order]


def align_chunk(a: Cutter, b: Cutter, names: list[np.ndarray], texts: list[str], piece: int = PIECE) -> dict:
    """Counts, digests, links and overlaps of a chunk's texts."""
    bodies = [b" " + t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    sizes, want = np.array([len(x) for x in bodies], np.int64), b"".join(bodies)
    cuts = [c.cut(texts) for c in (a, b)]
    ok = (sizes > 0) & same_bytes(a, *cuts[0], want, sizes) & same_bytes(b, *cuts[1], want, sizes)
    ids = [i[np.repeat(ok, n)] for i, n in cuts]
    counts = [np.where(ok, n, 0) for _, n in cuts]
    ends = [np.cumsum(c.sizes[i]) for c, i in zip((a, b), ids, strict=True)]
    at_a, at_b, both = overlaps(*ends, piece)
    last = [at_a[both], at_b[both]]
    closes = [np.zeros(len(i), np.int64) for i in ids]
    for c, x in zip(closes, last, strict=True):
        c[x] = 1
    text_of = np.repeat(np.arange(len(texts)), counts[0])[last[0]]
    groups = np.bincount(text_of, minlength=len(texts))
    words, digests, at = spelled(ids, closes, names), [], 0
    for n in (counts[0] + counts[1]).tolist():
        digests.append(sha256("".join(words[at:at + n].tolist())[:-1].encode()).hexdigest() if n else "")
        at += n
    return {"counts": counts, "groups": groups, "digests": digests, "text_of": text_of, "pairs": ids[0][last[0]] * b.n + ids[1][last[1]],
            "overlaps": (at_a, at_b), "overlap_of": np.repeat(np.arange(len(texts)), counts[0])[at_a]}


def lists(counts: np.ndarray, flat: np.ndarray, dtype: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(flat, dtype))


def aligned(docs: DataFrame, vocabulary: dict, model: bytes, text_col: str, keep: tuple[str, ...], piece: int = PIECE) -> DataFrame:
    """A row per text: ``keep``, chunk, n_a, n_b, n_groups, groups_sha256,
    slots and times (its links as places in the chunk's dictionary); the first
    row of a chunk holds the dictionary: pairs and how often each is linked."""
    names = list(keep)
    shipped = docs.sparkSession.sparkContext.broadcast((vocabulary, model))  # of one size; executors may not have the files

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(shipped.value[0]), piece_level(shipped.value[1])
        marks = [np.array([f"{i}{m}" for i in range(c.n) for m in ("," + e)], object) for c, e in ((a, "|"), (b, ";"))]
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column("__text")), 0), np.int64) + 1
            for x, y in chunks(size, CHUNK_BYTES):
                part, n = batch.slice(x, y - x), y - x
                got = align_chunk(a, b, marks, [t or "" for t in part.column("__text").to_pylist()], piece)
                book, slot = np.unique(got["pairs"], return_inverse=True)
                mine, times = np.unique(got["text_of"] * (len(book) + 1) + slot, return_counts=True)
                per_text = np.bincount(mine // (len(book) + 1), minlength=n)
                first = np.append(len(book), np.zeros(n - 1, np.int64))
                cols = {
                    "chunk": pa.array(np.full(n, number), pa.int64()), "n_a": pa.array(got["counts"][0], pa.int64()),
                    "n_b": pa.array(got["counts"][1], pa.int64()), "n_groups": pa.array(got["groups"], pa.int64()), "groups_sha256": pa.array(got["digests"], pa.string()),
                    "slots": lists(per_text, mine % (len(book) + 1), pa.int32()), "times": lists(per_text, times, pa.int32()),
                    "pairs": lists(first, book, pa.int64()), "linked": lists(first, np.bincount(slot, minlength=len(book)), pa.int64())}
                yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + list(cols.values()), names=[*names, *cols])
                number += 1

    more = "chunk long, n_a long, n_b long, n_groups long, groups_sha256 string, slots array<int>, times array<int>, pairs array<long>, linked array<long>"
    schema = T.StructType([docs.schema[c] for c in names] + T.StructType.fromDDL(more).fields)
    return docs.select(*names, docs[text_col].alias("__text")).mapInArrow(run, schema)


def align_tokens(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups_sha256 of each row: its tokens by A and by B, the groups that their
    common ends cut, its links, those whose pair is the most linked of all
    pairs with the same B token (ties included), and the sum of its links'
    corpus counts.

    Null and empty texts, and texts that a tokenizer doesn't give back byte for
    byte, have no tokens: zeros and an empty string. Rows are texts whatever
    their ids: null ids and repeated rows count as often as they come. Other
    columns are ignored, whatever their names; an empty table gives an empty
    result."""
    names = [f"__{i}" for i in range(len(keep))]
    src = docs.select(*[docs[c].alias(n) for c, n in zip(keep, names, strict=True)], docs[text_col].alias("__body"))
    model = Path(path_b).read_bytes()
    rows = stored(aligned(src, load_vocabulary(path_a), model, "__body", tuple(names)), "aligned")
    width = piece_level(model).n
    entries = rows.where(F.size("pairs") > 0).select("chunk", F.posexplode(F.arrays_zip("pairs", "linked")).alias("slot", "x")) \
        .select("chunk", "slot", F.col("x.pairs").alias("pair"), F.col("x.linked").alias("n"))
    counts = entries.groupBy("pair").agg(F.sum("n").alias("count"), F.count("*").alias("chunks"))
    counts = stored(counts, "pair-counts")
    b_id = F.pmod("pair", F.lit(width))
    top = counts.groupBy(b_id.alias("b")).agg(F.max("count").alias("most"))  # a row for each id of B at most
    stats = stored(counts.join(top, b_id == F.col("b")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"), "chunks"), "pair-stats")
    # a pair above this share of the entries can't be one of more than HOT_PAIRS
    share = max(1_000, (stats.agg(F.sum("chunks")).first()[0] or 0) // HOT_PAIRS)
    hot = F.broadcast(stats.where(F.col("chunks") > share).select("pair", "count", "best"))
    known = entries.join(hot, "pair", "inner").unionByName(
        entries.join(hot, "pair", "left_anti").join(stats.where(F.col("chunks") <= share).select("pair", "count", "best"), "pair"))

    def settle(texts: pa.Table, stats: pa.Table) -> pa.Table:
        n = stats.num_rows
        count, best = np.zeros(n, np.int64), np.zeros(n, bool)
        slot = stats.column("slot").to_numpy()
        count[slot], best[slot] = stats.column("count").to_numpy(), stats.column("best").to_numpy()
        slots, times = (texts.column(c).combine_chunks() for c in ("slots", "times"))
        sizes = np.asarray(pa.compute.list_value_length(slots), np.int64)
        of = np.repeat(np.arange(texts.num_rows), sizes)
        slot, time = np.asarray(slots.flatten(), np.int64), np.asarray(times.flatten(), np.int64)
        sums = [np.zeros(texts.num_rows, np.int64) for _ in range(2)]
        np.add.at(sums[0], of, time * best[slot])
        np.add.at(sums[1], of, time * count[slot])
        return texts.select([*names, "n_a", "n_b", "n_groups", "groups_sha256"]) \
            .append_column("n_best", pa.array(sums[0])).append_column("count_sum", pa.array(sums[1]))

    out = T.StructType([rows.schema[c] for c in (*names, "n_a", "n_b", "n_groups", "groups_sha256")]
                       + [T.StructField(c, T.LongType()) for c in ("n_best", "count_sum")])
    known = known.select("chunk", "slot", "count", "best").toDF("of", "slot", "count", "best")
    done = rows.drop("pairs", "linked").groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(settle, out)
    return done.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], "n_a", "n_b", "n_groups",
                       F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256")
