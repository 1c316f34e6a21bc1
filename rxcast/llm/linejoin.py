"""Line dedup by an exact set-similarity join (DataFrame operations only).

A line's tokens are its distinct words in lower case. A line goes if an
earlier line (by document, then place) has a Jaccard similarity of at least
``percent``, whether that one stays or not. Lines without a token stay.

* Lines with equal tokens are one set, known by its first occurrence: later
  occurrences go, and the first goes if a similar set begins earlier.
* Only the existence of an earlier partner matters. So sets are first held
  against the earliest set that has the same three smallest, or three largest,
  token hashes: this removes most of a large group of near copies in linear
  work, and what it removes needs no other partner.
* Small sets can only be similar if equal (n tokens and n + 1 share n / (n + 1)
  at most), so they go no further than the first step.
* The rest is exact. Tokens are ordered by rarity, counted over all lines;
  counts are kept per slot of the token's hash (``SLOTS`` of them, so the table
  has one size for any input; any fixed order is exact, rarity makes it fast).
  Of n tokens the first n - ceil(percent * n) + 1 are posted, as (token, set,
  size, place), and similar sets meet at the first token that they share. The
  smaller set of a pair has it among its first n * (1 - p) / (1 + p) + 1, so
  the later postings meet these alone, and not each other. Sizes
  and places must leave room for the overlap (length and positional filters;
  the tokens that an edit brings in are rare and come first, so the places of
  the rest tell), and so must a 128-bit parity sketch: each token in only one
  of two sets flips one bit, so the bits that differ bound the difference from
  below.
* Candidates are verified on the words of both lines.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxcast.llm.tables import stored

SLOT_BITS = 16
SLOTS = 1 << SLOT_BITS
#: Bytes up to which the documents and line numbers that a join looks for are broadcast.
BROADCAST_BYTES = 64 << 20
LOW = (1 << 32) - 1
SPACE = r"[\x20\x09-\x0D]+"


def split_parts(line: Column) -> Column:
    """Words of a line in lower case, and empty parts between blanks; blanks alone split faster than a pattern."""
    lower, other = F.lower(line), F.lit(False)
    for c in "\t\v\f\r":
        other = other | F.contains(line, F.lit(c))
    return F.when(other, F.split(lower, SPACE)).otherwise(F.split(lower, " "))


def split_words(line: Column) -> Column:
    """Words of a line in lower case."""
    return F.array_remove(split_parts(line), "")


def words(line: Column) -> Column:
    """Distinct words of a line."""
    return F.array_distinct(split_words(line))


def lookup(docs: DataFrame, wanted: DataFrame, how: str) -> DataFrame:
    """Join on ``__doc`` with (__doc, array of line numbers): ``wanted`` is
    broadcast after a look at its bytes (a row and its array take 64, a number
    4), else both sides are shuffled."""
    rows, numbers = wanted.agg(F.count("*"), F.sum(F.size(wanted.columns[1]))).first()
    few = 64 * rows + 4 * (numbers or 0) <= BROADCAST_BYTES
    return docs.join(F.broadcast(wanted) if few else wanted.hint("merge"), "__doc", how)


def numbered(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(__doc, <columns of docs>) with a unique number that follows the id, and
    bits that hold any line number. Ids that are unique and leave room for
    the line number are kept, less their minimum; others are numbered anew in
    their order (nulls first, equal ids by the text's CRC), from 0 without a
    gap. Both numbers together take 62 bits at most, else it is an error."""
    ident = F.col(id_col)
    total, known, low, high, most = docs.agg(F.count("*"), F.count(ident), F.min(ident), F.max(ident), F.max(F.octet_length(text_col))).first()
    bits = (int(most or 0) + 1).bit_length()  # no text has more lines than bytes and one
    unique = total == known and docs.select(id_col).distinct().count() == total
    if unique and int((high or 0) - (low or 0)).bit_length() + bits <= 62:
        return docs.withColumn("__doc", ident.cast("long") - (low or 0)), bits
    if int(total - 1).bit_length() + bits > 62:
        raise ValueError(f"{total} documents of up to {most} bytes leave no room for a line's number in 62 bits")
    ordered = docs.orderBy(ident.asc_nulls_first(), F.crc32(F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")))
    placed = stored(ordered.withColumn("__doc", F.monotonically_increasing_id()), "line-docs")
    # range << 33 | row: the ranges' counts become offsets, so that the numbers are dense whatever the partitions
    counts = {r.part: r.n for r in placed.groupBy(F.shiftright("__doc", 33).alias("part")).agg(F.count("*").alias("n")).collect()}
    offsets, rows = [], 0
    for part in range(max(counts, default=-1) + 1):
        offsets.append(rows)
        rows += counts.get(part, 0)
    offset = F.get(F.split(F.lit(",".join(map(str, offsets))), ",").cast("array<bigint>"), F.shiftright("__doc", 33).cast("int"))
    return placed.withColumn("__doc", offset + F.col("__doc").bitwiseAND((1 << 33) - 1)), bits


def rarity(lines: DataFrame) -> Column:
    """Literal array: the class of each slot's count, eight to an octave, from 1
    to 126. Empty parts count as a token that no line has."""
    slot = F.xxhash64("token").bitwiseAND(SLOTS - 1)
    counts = lines.select(F.explode(split_parts(F.col("line"))).alias("token")).groupBy(slot.alias("slot")) \
        .agg(F.count("*").alias("n")).toPandas()  # SLOTS rows at most
    classes = [1] * SLOTS
    for s, n in zip(counts["slot"].tolist(), counts["n"].tolist(), strict=True):
        classes[s] = min(126, 2 + int(8 * math.log2(n)))
    return F.split(F.lit(",".join(map(str, classes))), ",").cast("array<tinyint>")  # folded to a literal


def described(lines: DataFrame, classes: Column, percent: int) -> DataFrame:
    """(at, h1, h2, n, near1, near2, sketch, sketch2, rare) of the lines with
    tokens: hashes of the set, of its extremes, the parity sketch, and the
    posted tokens, rarest first. A token's key is its slot's class above the
    higher bits of its hash."""
    zero = F.lit(0).cast("bigint")
    rank = lambda h: F.coalesce(F.get(classes, h.bitwiseAND(SLOTS - 1).cast("int")), F.lit(0).cast("tinyint"))
    key = lambda h: F.shiftleft(rank(h).cast("bigint"), 56).bitwiseOR(F.shiftrightunsigned(h, 8))
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("bigint"), h.bitwiseAND(63).cast("int"))
    flip = lambda part: F.aggregate(part, zero, lambda b, h: b.bitwiseXOR(bit(h)))  # noqa: E731  parity of the tokens of a part
    # A higher-order function evaluates all that it is given without generated code, sorts and slices included. So each
    # stands alone here: its result is a column of a one-element explode, which the optimizer keeps apart from what follows.
    column = lambda array: F.explode(F.array(array))
    hashes = lines.select("at", column(F.transform(split_parts(F.col("line")), lambda w: F.xxhash64(w))).alias("h"))
    tokens = hashes.select("at", column(F.sort_array(F.array_remove(F.array_distinct("h"), F.xxhash64(F.lit(""))))).alias("t"))
    sets = tokens.where(F.size("t") > 0).select("at", "t", column(F.transform("t", key)).alias("k")).withColumn("n", F.size("t"))
    # negative hashes, which come first, flip one half of the sketch, the others the other
    sets = sets.withColumn("half", F.array_position(F.sort_array(F.array_append("t", zero)), zero).cast("int"))
    need = F.ceil(F.lit(percent) * F.col("n") / 100)
    sets = sets.select("at", "t", "n", "half", column(F.slice(F.sort_array("k"), F.lit(1), (F.col("n") - need + 1).cast("int"))).alias("first"))
    sets = sets.select("*", column(F.slice("t", F.lit(1), F.col("half") - 1)).alias("low"))
    sets = sets.select("*", column(F.slice("t", F.col("half"), F.col("n"))).alias("high"))
    return sets.select("at", F.xxhash64("t").alias("h1"), F.hash("t").alias("h2"), "n", F.xxhash64(F.slice("t", 1, 3)).alias("near1"),
                       F.xxhash64(F.lit(1), F.slice("t", -3, 3)).alias("near2"), flip("low").alias("sketch"),
                       flip("high").alias("sketch2"),
                       F.transform("first", lambda k: F.hash(k)).alias("rare"))


def alike(percent: int, n: Column, m: Column, sketch: str = "sketch") -> Column:
    """Length and sketch filters for sets of n and m tokens."""
    apart = F.bit_count(F.col(sketch).bitwiseXOR(F.col("marks"))) + F.bit_count(F.col(f"{sketch}2").bitwiseXOR(F.col("marks2")))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * (n + m - apart) >= 2 * percent * (n + m))


def reach(percent: int, n: Column, m: Column, i: Column, j: Column) -> Column:
    """Positional filter: the first token that similar sets share, at places i
    and j, has the whole overlap from there on. Later ones needn't pass."""
    return (100 + percent) * F.least(n - i, m - j) >= percent * (n + m)


def short_prefix(percent: int, n: Column, size: Column) -> Column:
    """How many of a set's first tokens can be the first one that it shares
    with a similar set of its size or above: from there on it must have the
    overlap with its equal in size, by ``reach``. The later of its ``size``
    posted tokens can only be shared first with a smaller set."""
    return F.least(F.floor((100 - percent) * n / (100 + percent)).cast("int") + 1, size)


def packed(high: Column, low: Column) -> Column:
    """Two ints (the lower one's bits as they are) in a long."""
    return F.shiftleft(high.cast("bigint"), 32).bitwiseOR(low.cast("bigint").bitwiseAND(LOW))


def meeting(one: DataFrame, other: DataFrame, percent: int, itself: bool) -> DataFrame:
    """(at, before): pairs of postings of the same token that pass the
    filters, where the later line needs a partner. Postings that meet
    themselves give each pair once, with the later line on the left."""
    n, m = F.shiftright("sized", 32), F.shiftright("sized2", 32)
    i, j = (F.shiftright(F.col(c).bitwiseAND(LOW), 1) for c in ("sized", "sized2"))
    line, before = F.col("line"), F.col("before")
    # most pairs end at one half of the sketch, so that comes first and takes both sizes in one sum
    half = (100 + percent) * F.bit_count(F.col("bits").bitwiseXOR(F.col("marks"))) <= (100 - percent) * F.shiftright(F.col("sized") + F.col("sized2"), 32)
    mirrored = F.lit(0) if itself else F.when(line < before, F.col("sized2").bitwiseAND(1)).otherwise(0)
    wanted = F.when(line > before, F.col("sized").bitwiseAND(1)).otherwise(mirrored) > 0
    # with the token ahead in common as well, the pair has met there, at places that pass if these do
    first = (F.least(i, j) == 0) | (F.col("token") != F.col("same"))
    return one.join(other.hint("merge"), F.shiftright("token", 32) == F.shiftright("same", 32)) \
        .where(half & wanted & first & reach(percent, n, m, i, j) & alike(percent, n, m, "bits")) \
        .select(F.greatest(line, before).alias("at"), F.least(line, before).alias("before"))


def smallest_pair(percent: int) -> int:
    """Tokens that a set needs so that a different set can be similar: with n
    of n + 1 in common, n / (n + 1) must reach ``percent``. Equal sets alone
    are similar below, and at 100 at any size."""
    return -(-percent // (100 - percent)) if percent < 100 else 1 << 30


def removable(docs: DataFrame, bits: int, percent: int, text_col: str) -> DataFrame:
    """(__doc, __gone): the numbers of the lines that an earlier one makes
    superfluous, an array per document that has any."""
    lines = docs.select("__doc", F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line"))
    at = F.shiftleft("__doc", bits).bitwiseOR(F.col("line_no"))
    table = stored(described(lines.select(at.alias("at"), "line"), rarity(lines), percent), "lines")

    firsts = stored(table.groupBy("h1", "h2", "n").agg(F.min("at").alias("at"), *[F.any_value(c).alias(c) for c in ("near1", "near2", "sketch", "sketch2")])
                    .drop("h1", "h2"), "line-sets")
    open_sizes = F.col("n") >= smallest_pair(percent)
    ends = firsts.where(open_sizes).select("at", "n", "sketch", "sketch2", F.explode(F.array("near1", "near2")).alias("near"))
    # buffers of numbers are aggregated by hash, a smallest struct would be by sorting
    heads = ends.groupBy("near").agg(F.min("at").alias("before"), *[F.min_by(c, "at").alias(to) for c, to in (("n", "m"), ("sketch", "marks"), ("sketch2", "marks2"))],
                                     F.count("*").alias("of")).where("of > 1").drop("of")
    # the hashed side of these joins has a key once, and numbers only: no sort of the wide side
    star = ends.join(heads.hint("shuffle_hash"), "near").where((F.col("before") < F.col("at")) & alike(percent, F.col("n"), F.col("m"))).select("at", "before").distinct()
    gone = similar(docs, star, bits, percent, text_col)

    open_ = firsts.where(open_sizes).select("at").join(gone.select("at", F.lit(True).alias("done")).hint("shuffle_hash"), "at", "left") \
        .select(F.col("at").alias("first"), F.col("done").isNull().cast("int").alias("open"))
    sets = table.select("at", "n", "sketch", "sketch2", "rare").join(open_.hint("shuffle_hash"), F.col("at") == F.col("first"))
    # postings are unpacked by the joins alone, so that the exchanges move few columns
    size, ahead = F.size("rare"), F.concat(F.array(F.lit(0)), F.slice("rare", F.lit(1), F.size("rare") - 1))
    sets = sets.select("at", "n", "open", "sketch", "sketch2",
                       F.arrays_zip(F.col("rare").alias("code"), ahead.alias("ahead")).alias("x"), short_prefix(percent, F.col("n"), size).alias("cut"))

    def posted(part: Column, place: Column) -> DataFrame:
        return sets.select("at", "n", "open", "sketch", "sketch2", place.alias("from"), F.posexplode(part).alias("place", "x")).select(
            packed(F.col("x.code"), F.col("x.ahead")), "at", packed(F.col("n"), 2 * (F.col("from") + F.col("place")) + F.col("open")), "sketch", "sketch2")
    # each part is shuffled once: all sides of the joins rename every column, and those of the first part read the same exchange
    short, long = posted(F.slice("x", F.lit(1), F.col("cut")), F.lit(0)), posted(F.slice("x", F.col("cut") + 1, F.size("x")), F.col("cut"))
    other = short.toDF("same", "before", "sized2", "marks", "marks2")
    rest = None
    for part in (short, long):
        met = meeting(part.toDF("token", "line", "sized", "bits", "bits2"), other, percent, part is short)
        rest = met if rest is None else rest.union(met)
    rest = rest.distinct()
    gone = gone.union(similar(docs, rest, bits, percent, text_col)).distinct()

    stays = firsts.select("at").join(gone.hint("shuffle_hash"), "at", "left_anti")
    lost = table.select("at").join(stays.hint("shuffle_hash"), "at", "left_anti")
    return stored(lost.groupBy(F.shiftright("at", bits).alias("__doc")).agg(
        F.collect_list(F.col("at").bitwiseAND((1 << bits) - 1).cast("int")).alias("__gone")), "line-gone")


def similar(docs: DataFrame, pairs: DataFrame, bits: int, percent: int, text_col: str) -> DataFrame:
    """(at): first lines of the candidate pairs that reach the similarity."""
    pairs = stored(pairs, "line-pairs")
    ends = pairs.select("at").union(pairs.select("before")).distinct()
    by_doc = ends.groupBy(F.shiftright("at", bits).alias("__doc")).agg(
        F.collect_list(F.col("at").bitwiseAND((1 << bits) - 1).cast("int")).alias("wanted"))
    # only the wanted lines of a document leave this projection
    found = lookup(docs.select("__doc", text_col), by_doc, "inner").select("__doc", F.explode(F.expr(
        f"transform(array(split(`{text_col}`, '\\n')), ls -> transform(wanted, i -> struct(i AS i, ls[i] AS line)))[0]")).alias("x"))
    # lines are shorter than arrays of their words, so the pairs are made of lines
    known = stored(found.select(F.shiftleft("__doc", bits).bitwiseOR(F.col("x.i")).alias("at"), F.col("x.line").alias("line")), "line-texts")
    both = pairs.join(known, "at").join(known.select(F.col("at").alias("before"), F.col("line").alias("other")), "before") \
        .select("at", F.inline(F.array(F.struct(words(F.col("line")).alias("w"), words(F.col("other")).alias("v")))))
    enough = (100 + percent) * F.size(F.array_intersect("w", "v")) >= percent * (F.size("w") + F.size("v"))
    return stored(both.where(enough).select("at").distinct(), "line-similar")


def dedup_lines(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                lines_col: str = "n_lines", removed_col: str = "n_removed") -> DataFrame:
    """The rows of ``docs`` with the text less its removed lines, and the
    numbers of lines and of removed ones beside (their names replace columns
    of ``docs``, as does ``__doc`` inside).

    Nulls: a null text has no line and stays null; a null id comes first. An
    empty text is one empty line. Rows that repeat an id are documents of
    their own, ordered by their texts' CRC, so of repeated rows all lines but
    the first row's go. An empty table gives an empty result."""
    keep = [c for c in docs.columns if c not in ("__doc", lines_col, removed_col)]
    rows, bits = numbered(docs.select(*keep), id_col, text_col)
    gone = removable(rows, bits, percent, text_col)
    split = F.split(F.col(text_col), "\n")
    left = F.expr(f"transform(array(split(`{text_col}`, '\\n')), ls -> array_join(transform("
                  "array_except(sequence(0, size(ls) - 1), __gone), i -> ls[i]), '\\n'))[0]")
    joined = lookup(rows, gone, "left")
    return joined.select(*[F.when(F.col("__gone").isNull(), F.col(c)).otherwise(left).alias(c) if c == text_col else F.col(c) for c in keep],
                         F.when(F.col(text_col).isNull(), 0).otherwise(F.size(split)).cast("long").alias(lines_col),
                         F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias(removed_col))
