"""Byte-level BPE in batched numpy merge rounds.

The words of a batch that the task hasn't met yet sit in one flat array of
symbols. A round forms the key of each neighbouring pair inside a word, finds
its rank by binary search over the sorted pair keys, takes each word's lowest
rank and merges every place where it stands (in overlapping runs, every other
place from the left). Words without a known pair leave the array. Documents
are then a ragged gather over the words' ids; decoding is one over the
tokens' bytes.

The vocabulary comes from a ``tokenizers`` JSON file whose path is a
parameter; the driver parses it and broadcasts the tables, whose size the file
fixes (about 2 MB for 50,000 merges).
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Fixed value: the split that byte-level BPE vocabularies of this kind use.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Text bytes that a task handles at once, and words that it remembers.
CHUNK_BYTES, REMEMBERED = 512 << 10, 200_000
#: Bytes of ids that a task decodes at once.
DECODE_BYTES = 512 << 10
#: Characters above which a word is merged with linked symbols.
LONG = 200


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in the file."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def load_vocabulary(path: str) -> dict:
    """Numpy tables of a byte-level BPE file: sorted pair keys with rank and
    merged id, the id of each byte, the bytes of each id, special strings."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    ids, n = dict(model["vocab"]), max(model["vocab"].values()) + 1
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    n = max([n, *(i + 1 for i in special.values())])
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    keys = np.array([ids[a] * n + ids[b] for a, b in pairs], np.int64)
    merged = np.array([ids[a + b] for a, b in pairs], np.int32)
    order = np.argsort(keys, kind="stable")
    of_char = {c: b for b, c in enumerate(byte_chars())}
    raw = [b""] * n
    for token, i in ids.items():
        raw[i] = bytes(of_char[c] for c in token) if all(c in of_char for c in token) else token.encode()
    for token, i in special.items():
        raw[i] = token.encode()
    sizes = np.array([len(x) for x in raw], np.int64)
    return {
        "n": n, "keys": keys[order], "rank": order.astype(np.int32), "merged": merged[order],
        "byte_ids": np.array([ids[c] for c in byte_chars()], np.int32), "special": special,
        "bytes": np.frombuffer(b"".join(raw), np.uint8), "sizes": sizes, "starts": np.cumsum(sizes) - sizes,
    }


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start+1, ... of every run, one after the other."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - sizes), sizes)


def merge_long(words: list[bytes], v: dict) -> tuple[np.ndarray, np.ndarray]:
    """As ``merge_words``, for words of any length: the symbols are linked, a
    round merges the lowest rank of all words, and only the pairs next to the
    last merges are looked up again, so the work follows the symbols and not
    symbols times rounds."""
    sizes = np.array([len(w) for w in words], np.int64)
    keys, ranks, merged, n, none = v["keys"], v["rank"], v["merged"], v["n"], 2**31 - 1
    end = int(sizes.sum())  # stands for no symbol
    sym = np.append(v["byte_ids"][np.frombuffer(b"".join(words), np.uint8)].astype(np.int64), 0)
    after, before = np.arange(1, end + 2), np.arange(-1, end)
    after[np.cumsum(sizes) - 1] = end
    before[np.cumsum(sizes) - sizes] = end
    now = np.full(end + 1, none, np.int64)
    waiting: dict[int, list[np.ndarray]] = {}
    order: list[int] = []

    def look(at: np.ndarray) -> None:
        pair = sym[at] * n + sym[after[at]]
        slot = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        found = np.where((keys[slot] == pair) & (after[at] != end), ranks[slot], none)
        now[at] = found
        at, found = at[found != none], found[found != none]
        by = np.argsort(found, kind="stable")
        at, found = at[by], found[by]
        cuts = np.flatnonzero(np.diff(found)) + 1
        for rank, places in zip(found[np.append(0, cuts)].tolist() if len(found) else [], np.split(at, cuts), strict=False):
            if rank not in waiting:
                heapq.heappush(order, rank)
            waiting.setdefault(rank, []).append(places)

    look(np.arange(end))
    of_rank = np.empty(len(keys), np.int64)
    of_rank[ranks] = merged
    while order:
        rank = heapq.heappop(order)
        at = np.unique(np.concatenate(waiting.pop(rank)))
        at = at[now[at] == rank]
        if not len(at):
            continue
        run = np.append(True, after[at[:-1]] != at[1:])
        start = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - start) % 2 == 0]  # in a run of one symbol, every other pair from the left
        gone = after[at]
        sym[at], now[gone], after[at] = of_rank[rank], none, after[gone]
        before[after[at]] = at
        sym[gone] = -1
        touched = np.concatenate([at, before[at]])
        look(np.unique(touched[(touched != end) & (sym[touched] >= 0)]))
    left = sym[:-1] >= 0
    word = np.repeat(np.arange(len(words)), sizes)
    return sym[:-1][left].astype(np.int32), np.bincount(word[left], minlength=len(words))


def merge_words(words: list[bytes], v: dict) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words in one array, and how many each has."""
    sizes = np.array([len(w) for w in words], np.int64)
    sym = v["byte_ids"][np.frombuffer(b"".join(words), np.uint8)].astype(np.int64)
    word = np.repeat(np.arange(len(words)), sizes)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    keys, ranks, merged, n = v["keys"], v["rank"], v["merged"], v["n"]
    none = np.int32(2**31 - 1)
    while len(sym):
        pair = sym[:-1] * n + sym[1:]
        at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        known = (keys[at] == pair) & (word[:-1] == word[1:])
        rank = np.append(np.where(known, ranks[at], none), none)
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        low = np.minimum.reduceat(rank, first)
        span = np.diff(np.append(first, len(sym)))
        open_ = np.repeat(low != none, span)
        if not open_.all():
            done.append((sym[~open_], word[~open_]))
        take = open_ & (rank == np.repeat(low, span))
        here = np.flatnonzero(take)
        if len(here):
            run = np.append(True, (np.diff(here) != 1) | (word[here[1:]] != word[here[:-1]]))
            start = np.maximum.accumulate(np.where(run, np.arange(len(here)), 0))
            here = here[(np.arange(len(here)) - start) % 2 == 0]
            sym[here] = merged[at[here]]
            open_[here + 1] = False
        sym, word = sym[open_], word[open_]
    if not done:
        return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
    sym, word = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(word, kind="stable")
    return sym[order].astype(np.int32), np.bincount(word, minlength=len(words))


class Encoder:
    """Ids of whole texts; remembers words between batches of one task."""

    def __init__(self, v: dict):
        self.v, self.split = v, regex.compile(SPLIT)
        names = sorted(v["special"], key=lambda s: (-len(s), s))
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.forget()

    def forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.ids, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for s, i in self.v["special"].items():
            self.add([s], np.array([i], np.int32), np.array([1]))

    def add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.append(self.starts, len(self.ids) + np.cumsum(sizes) - sizes)
        self.sizes = np.append(self.sizes, sizes)
        self.ids = np.append(self.ids, ids)
        for w in words:
            self.slot[w] = len(self.slot)

    def words(self, text: str) -> list[str]:
        if self.special is None or not self.special.search(text):
            return self.split.findall(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += self.split.findall(text[at:m.start()])
            out.append(m[0])
            at = m.end()
        return out + self.split.findall(text[at:])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each has."""
        if len(self.slot) > REMEMBERED:
            self.forget()
        split = [self.words(t) for t in texts]
        counts = np.array([len(x) for x in split], np.int64)
        flat = [w for x in split for w in x]
        new = set(flat) - self.slot.keys()
        long = [w for w in new if len(w) > LONG]
        for merge, few in ((merge_long, long), (merge_words, list(new.difference(long)))):
            if few:
                self.add(few, *merge([w.encode("utf-8") for w in few], self.v))
        slot = np.fromiter(map(self.slot.__getitem__, flat), np.int64, len(flat))
        sizes = self.sizes[slot]
        ids = self.ids[ragged(self.starts[slot], sizes)]
        upto = np.append(0, np.cumsum(sizes))
        ends = np.cumsum(counts)
        return ids, upto[ends] - upto[ends - counts]


def decode_ids(flat: np.ndarray, sizes: np.ndarray, v: dict) -> list[str]:
    """Text of each run of ids; ids outside the vocabulary are skipped and
    bytes that form no UTF-8 become U+FFFD."""
    ok = (flat >= 0) & (flat < v["n"])
    ids = np.where(ok, flat, 0)
    lens = np.where(ok, v["sizes"][ids], 0)
    data = v["bytes"][ragged(v["starts"][ids], lens)].tobytes()
    upto, ends = np.append(0, np.cumsum(lens)), np.cumsum(sizes)
    cut = zip(upto[ends - sizes].tolist(), upto[ends].tolist(), strict=True)
    return [data[a:b].decode("utf-8", "replace") for a, b in cut]


def chunks(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows whose sizes sum up to about ``most``; at least a row each."""
    if not len(sizes):
        return
    part = np.cumsum(sizes) // max(most, 1)
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    yield from zip(edges[:-1], edges[1:], strict=True)


def _with_list(batch: pa.RecordBatch, keep: list[str], name: str, offsets: np.ndarray, flat: np.ndarray):
    ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
    return pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [ids], names=[*keep, name])


def bpe_encode(docs: DataFrame, vocabulary: str | dict, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
               ids_col: str = "ids") -> DataFrame:
    """``keep`` columns and the token ids of each whole text.

    A null text counts as empty and gives an empty array; rows are
    independent, so repeated rows, null ids and empty tables need no rule.
    Columns that aren't in ``keep`` are ignored."""
    tables = _shipped(docs.sparkSession, vocabulary)
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(tables.value)
        for batch in batches:
            size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column("__text")), 0), np.int64) + 1
            for a, b in chunks(size, CHUNK_BYTES):
                part = batch.slice(a, b - a)
                ids, sizes = enc.encode([t or "" for t in part.column("__text").to_pylist()])
                yield _with_list(part, names, ids_col, np.append(0, np.cumsum(sizes)), ids)

    src = docs.select(*names, docs[text_col].alias("__text"))
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField(ids_col, T.ArrayType(T.IntegerType()))])
    return src.mapInArrow(run, schema)


def bpe_decode(encoded: DataFrame, vocabulary: str | dict, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",),
               text_col: str = "text") -> DataFrame:
    """``keep`` columns and the text of each row's ids (null: empty; null
    elements and ids outside the vocabulary are skipped). Ids that are kept
    travel once."""
    tables = _shipped(encoded.sparkSession, vocabulary)
    names = list(keep)
    source = ids_col if ids_col in names else "__ids"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = tables.value
        for batch in batches:
            size = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(batch.column(source)), 0), np.int64)
            for a, b in chunks(4 * size + 1, DECODE_BYTES):
                part = batch.slice(a, b - a)
                flat = part.column(source).flatten()
                flat = np.asarray(pa.compute.fill_null(flat, -1), np.int64)
                text = pa.array(decode_ids(flat, size[a:b], v), pa.string())
                yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + [text], names=[*names, text_col])

    schema = T.StructType([encoded.schema[c] for c in names] + [T.StructField(text_col, T.StringType())])
    src = encoded.select(*names, *[encoded[ids_col].alias(source)] * (source not in names))
    return src.mapInArrow(run, schema)


def _shipped(spark: SparkSession, vocabulary: str | dict):
    return spark.sparkContext.broadcast(load_vocabulary(vocabulary) if isinstance(vocabulary, str) else vocabulary)
