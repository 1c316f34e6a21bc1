from collections import Counter

import corpus_pipeline as cp
import pytest
from llm_fixtures import SF_CHECK, labels, no_documents, odd_documents  # noqa: F401
from test_lines import brute as brute_lines
from test_mix import targets
from test_near_dedup import groups

from rxcast.llm.tables import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The table before and after each stage."""
    docs, out = spark.read.parquet(f"{SF_CHECK}/documents.parquet"), []
    for name, f in cp.STAGES:
        after = stored(f(spark, docs, SF_CHECK), "test")
        out.append((name, docs, after))
        docs = after
    return out


def test_names_and_columns(stages):
    assert [n for n, *_ in stages] == ["quality_classifier", "line_dedup", "minhash_near_dedup", "source_mix", "bpe_tokens"]
    assert all(after.columns == COLUMNS for _, _, after in stages[:-1])


def test_quality_keeps_good_documents(spark, stages):
    _, before, after = stages[0]
    known = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_CHECK}/labels.parquet").collect()}
    kept = {r.doc_id for r in after.collect()}
    good, bad = ([i for i, q in known.items() if q == v] for v in (1, 0))
    assert sum(i in kept for i in good) >= 0.98 * len(good) and sum(i in kept for i in bad) <= 0.15 * len(bad)


def test_lines_equal_brute_force(stages):
    _, before, after = stages[1]
    rows = sorted((r.doc_id, r.text) for r in before.collect())[:150]
    got = {r.doc_id: r for r in after.collect()}
    for i, text, lost in brute_lines(rows):
        if lost and not text.split():
            assert i not in got
        else:
            assert got[i].text == text and (not lost or got[i].n_chars == len(text))


def test_one_document_of_each_group_stays(stages):
    _, before, after = stages[2]
    want = groups({r.doc_id: r.text for r in before.collect()}, 5)
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i, (_, root) in want.items() if root == i)


def test_mix_meets_its_targets(stages):
    _, before, after = stages[3]
    words = lambda rows: Counter() + sum((Counter({r.source: len(r.text.encode().split())}) for r in rows), Counter())
    size, taken = words(before.collect()), words(after.collect())
    rule = targets(dict(size))
    assert all(abs(taken[s] - rule[s]) < 0.1 * rule[s] for s in rule)
    assert max(Counter(r.doc_id for r in after.collect()).values()) <= 3


def test_tokens_of_every_row(stages):
    _, before, after = stages[4]
    assert Counter(r.doc_id for r in after.collect()) == Counter(r.doc_id for r in before.collect())
    assert all(len(r.ids) == r.n_tokens for r in after.collect())


def test_stages_take_odd_rows_and_empty_tables(spark, tmp_path, odd_documents, no_documents, labels):  # noqa: F811
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (odd_documents, no_documents):
        for name, f in cp.STAGES:
            after = stored(f(spark, docs, str(tmp_path)), "test")
            assert name == "bpe_tokens" or after.columns == docs.columns
            if name == "minhash_near_dedup" and docs is odd_documents:
                ids = [r.doc_id for r in after.collect()]
                assert sorted(i for i in ids if i is not None) == [0, 2, 3, 4, 5, 6, 8, 9, 10, 11] and ids.count(None) == 1
            if name in ("quality_classifier", "minhash_near_dedup"):
                assert after.count() <= docs.count()
    assert after.count() == 0


def test_run_writes_and_rereads_each_stage(spark, stages):
    rows = cp.run(spark, SF_CHECK)
    assert rows.count() == stages[-1][2].count()
