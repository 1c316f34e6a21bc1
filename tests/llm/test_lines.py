import pytest
from llm_fixtures import SF_CHECK, no_documents, odd_documents  # noqa: F401

from rxcast.llm.linejoin import dedup_lines, numbered


def brute(docs):
    """Text and number of removed lines per document, in order of (id, place); every pair of lines is compared."""
    seen, out = [], []
    for i, t in docs:
        if t is None:
            out.append((i, None, 0))
            continue
        kept, lost = [], 0
        for line in t.split("\n"):
            w = {x for x in line.lower().split() if x}
            if w:
                if any(100 * len(w & v) >= 80 * len(w | v) for v in seen):
                    lost += 1
                    seen.append(w)
                    continue
                seen.append(w)
            kept.append(line)
        out.append((i, "\n".join(kept), lost))
    return out


def test_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").where("doc_id < 220")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = sorted((r.doc_id, r.text, r.n_removed) for r in dedup_lines(docs).select("doc_id", "text", "n_removed").collect())
    assert got == brute(rows)


def test_group_of_near_copies_with_ties(spark):
    words = [f"word{i}" for i in range(20)]
    texts = [" ".join(words[:i % 20] + [f"edit{i}"] + words[i % 20 + 1:]) for i in range(200)] + [" ".join(words)] * 50
    rows = list(enumerate(texts))
    got = sorted((r.doc_id, r.text, r.n_removed) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
                 .select("doc_id", "text", "n_removed").collect())
    assert got == brute(rows)


def test_short_lines_and_lines_without_spaces(spark):
    long = "彼は昨日東京へ行きました。" * 5
    rows = [(0, f"Terms of\n{long}\nhttps://example.org/{'a' * 300}\n\nLes.\na b c\na b c d"),
            (1, f"terms OF of\n\n{long}\nles. Les.\na b c x\na b c d e\nb a"), (2, f"https://example.org/{'a' * 300}\na b\n \nother"), (3, None)]
    got = sorted((r.doc_id, r.text, r.n_removed) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
                 .select("doc_id", "text", "n_removed").collect())
    assert got == brute(rows) and got[1][1:] == ("\na b c x\nb a", 4) and got[2][1:] == (" \nother", 2)


def test_lookups_beyond_the_broadcast_bound(spark, monkeypatch):
    from rxcast.llm import linejoin
    monkeypatch.setattr(linejoin, "BROADCAST_BYTES", 0)
    rows = [(i, f"one line that is common\nline {i} of its own {i * i} here\nx{i % 7}") for i in range(60)]
    got = sorted((r.doc_id, r.text, r.n_removed) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
                 .select("doc_id", "text", "n_removed").collect())
    assert got == brute(rows)


def test_postings_are_narrow_and_shuffled_once(spark, monkeypatch):
    """Both sides of the postings' join read one exchange of five columns."""
    from rxcast.llm import linejoin
    plans, inner = [], linejoin.similar

    def seen(docs, pairs, *args):
        plans.append(pairs._jdf.queryExecution().executedPlan().toString())
        pairs.collect()
        plans.append(pairs._jdf.queryExecution().executedPlan().toString())
        return inner(docs, pairs, *args)
    monkeypatch.setattr(linejoin, "similar", seen)
    monkeypatch.setattr(linejoin, "BROADCAST_BYTES", 0)
    rows = [(i, f"line {i // 2} of its own {i * i // 3} here and more words {i % 3}") for i in range(60)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = sorted((r.doc_id, r.text, r.n_removed) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
                     .select("doc_id", "text", "n_removed").collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == brute(rows) and "ReusedExchange [token" in plans[-1].replace("same", "token")
    posted = [line for line in plans[-1].splitlines() if "Exchange hashpartitioning(shiftright(" in line]
    assert posted


def test_sketch_halves_are_the_signs_of_the_hashes(spark):
    """Each half holds the parity of its tokens, also where a half has none."""
    from pyspark.sql import functions as F

    from rxcast.llm.linejoin import described, rarity, split_words
    rows = [(i, " ".join(f"w{i * k % 97}" for k in range(1 + i % 9))) for i in range(90)]
    lines = spark.createDataFrame(rows, "at long, line string")
    hashes = {r["at"]: set(r.t) for r in lines.select("at", F.transform(split_words(F.col("line")), lambda w: F.xxhash64(w)).alias("t")).collect()}
    for r in described(lines, rarity(lines), 80).collect():
        halves = [0, 0]
        for h in hashes[r["at"]]:
            halves[h >= 0] ^= 1 << (h & 63)
        assert [x % (1 << 64) for x in (r.sketch, r.sketch2)] == halves and r.n == len(hashes[r["at"]])


def test_higher_order_functions_get_ready_columns(spark):
    """A higher-order function evaluates its arguments without generated code: no sort or distinct may stand inside one."""
    import re

    from pyspark.sql import functions as F

    from rxcast.llm.linejoin import described
    lines = spark.range(3).select(F.col("id").alias("at"), F.lit("some words of a line").alias("line")).repartition(2)
    classes = F.split(F.lit(",".join(["1"] * 65536)), ",").cast("array<tinyint>")
    plan = described(lines, classes, 80)._jdf.queryExecution().optimizedPlan().toString()
    given = re.findall(r"\b(?:transform|filter|aggregate)\((.*?)lambdafunction", plan, re.S)
    assert len(given) == 5 and not [g[:200] for g in given if "sort_array" in g or "array_distinct" in g]


def test_later_postings_meet_the_first_ones_alone(spark, monkeypatch):
    """Postings that only a smaller set can share first don't meet each other, whichever line comes first."""
    from rxcast.llm import linejoin
    calls, inner = [], linejoin.meeting

    def seen(one, other, percent, itself):
        met = inner(one, other, percent, itself)
        calls.append((one.count(), other.count(), met.count()))
        return met
    monkeypatch.setattr(linejoin, "meeting", seen)
    # 'common' words are frequent and come last; 40 of them plus up to 10 rare ones: the smaller set has no rare word, so a
    # pair shares its first word late in the larger set's prefix. In half of the pairs the larger set comes first.
    rows = []
    for g in range(12):
        common = [f"c{g}x{k}" for k in range(40)]
        large, small = " ".join([f"rare{g}y{k}" for k in range(9)] + common), " ".join(common)
        rows += [(2 * g, (large, small)[g % 2]), (2 * g + 1, (small, large)[g % 2])]
    rows += [(100 + i, " ".join(f"c{i % 12}x{k}" for k in range(i % 7, 40, 7))) for i in range(84)]
    got = sorted((r.doc_id, r.text, r.n_removed) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
                 .select("doc_id", "text", "n_removed").collect())
    assert got == brute(rows) and sum(n for i, _, n in got if i < 100) == 12
    (first, reused, _), (later, alone, late) = calls
    assert first == reused == alone and 0 < later and late > 0


def test_a_pair_meets_once_in_the_join(spark, monkeypatch):
    """Near copies that share their first word make one row a pair, not one for either order."""
    from rxcast.llm import linejoin
    calls, inner = [], linejoin.meeting

    def seen(*args):
        met = inner(*args)
        calls.append(met.groupBy("at", "before").count().where("count > 1").count())
        return met
    monkeypatch.setattr(linejoin, "meeting", seen)
    # edits of the first and last words by hash leave heads that differ, so that pairs are left to the join
    rows = [(i, " ".join([f"a{i // 2}"] + [f"w{i // 4}x{k}" for k in range(24) if k != i % 4])) for i in range(80)]
    got = sorted((r.doc_id, r.text, r.n_removed) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
                 .select("doc_id", "text", "n_removed").collect())
    assert got == brute(rows) and calls == [0, 0]


def test_prefix_that_meets_all_is_exact():
    """No pair of sizes and places passes the positional filter with both places behind the short prefix."""
    for percent in (50, 80, 95):
        for n in range(1, 60):
            for m in range(1, n + 1):
                cut, cut2 = ((100 - percent) * x // (100 + percent) + 1 for x in (n, m))
                assert not any((100 + percent) * min(n - i, m - j) >= percent * (n + m) for i in range(cut, n) for j in range(cut2, m))
                assert not any((100 + percent) * min(n - i, m - j) >= percent * (n + m) for i in range(n) for j in range(cut2, m))


def test_short_prefix_follows_the_size(spark):
    from pyspark.sql import functions as F

    from rxcast.llm.linejoin import short_prefix
    rows = spark.range(1, 60).select(F.col("id").cast("int").alias("n"))
    for percent in (50, 80, 95):
        size = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100).cast("int") + 1
        for r in rows.select("n", size.alias("size"), short_prefix(percent, F.col("n"), size).alias("cut")).collect():
            assert r.cut == min(r["size"], (100 - percent) * r.n // (100 + percent) + 1) >= 1


def test_odd_rows(spark, odd_documents, no_documents):
    rows = dedup_lines(odd_documents).collect()
    assert len(rows) == 15 and set(rows[0].asDict()) == {*odd_documents.columns, "n_lines", "n_removed"}
    by = {r.doc_id: r for r in rows if r.doc_id not in (None, 9)}
    assert by[3].text is None and by[3].n_lines == 0 and by[4].text == "" and by[4].n_lines == 1
    assert by[1].text == "" and by[1].n_removed == 1 and by[0].n_removed == 0
    assert by[2].text == "second line of this text here" and by[5].text == " \n\t "
    assert by[11].text == "same line of words" and by[11].n_removed == 2
    assert sorted(r.text for r in rows if r.doc_id is None) == ["", "no id here at all"]
    assert sorted(r.text for r in rows if r.doc_id == 9) == ["", "two words"]
    assert dedup_lines(no_documents).count() == 0


def test_numbers_of_wide_ids_leave_room_for_the_lines(spark, tmp_path):
    """Ids of 64 bits over many ranges, and a text that needs 23 bits for a line number."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {n: spark.conf.get(n) for n in names}
    rows = sorted((((i + 1) * 0x9E3779B97F4A7C15 + 2**63) % 2**64 - 2**63, f"unique{i} text of document {i}\nthis line stands in pair {i // 2}")
                  for i in range(280))
    rows[7] = (rows[7][0], "x" * (1 << 22))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents")
    docs = spark.read.parquet(f"{tmp_path}/documents")
    try:
        for name, value in zip(names, ("140", "false"), strict=True):
            spark.conf.set(name, value)
        doc, bits = numbered(docs, "doc_id", "text")
        found = doc.select("__doc", "doc_id").collect()
        got = sorted((r.doc_id, r.text, r.n_removed) for r in dedup_lines(docs).select("doc_id", "text", "n_removed").collect())
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert bits == 23 and sorted((r["__doc"], r.doc_id) for r in found) == list(enumerate(i for i, _ in rows))
    assert got == brute(rows) and sum(n for *_, n in got) > 100


def test_numbers_without_room_are_an_error(spark):
    class Docs:
        """A table whose size is only claimed."""
        columns = ["doc_id", "text"]

        def agg(self, *_):
            return self

        def first(self):
            return 1 << 40, 0, None, None, 1 << 30
    with pytest.raises(ValueError, match="62 bits"):
        numbered(Docs(), "doc_id", "text")
