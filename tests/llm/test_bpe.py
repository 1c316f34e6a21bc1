import random
import time

import public_tokenizers
import pytest
from llm_fixtures import SF_CHECK, no_documents, odd_documents  # noqa: F401
from tokenizers import Tokenizer

from rxcast.llm.bpe import Encoder, bpe_decode, bpe_encode, load_vocabulary, merge_long, merge_words

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_every_code_point(library):
    points = [c for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    texts = [f"a {chr(c)}{chr(c)}1 {chr(c)}a  {chr(c)} b" for c in points]
    ids, sizes = Encoder(load_vocabulary(PATH)).encode(texts)
    ids, at = ids.tolist(), 0
    for n, e in zip(sizes.tolist(), library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids[at:at + n] == e.ids
        at += n


def test_whole_table_like_the_library(spark, library):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    ids = bpe_encode(docs, PATH)
    got = {r.doc_id: r.ids for r in ids.collect()}
    back = {r.doc_id: r.text for r in bpe_decode(ids, PATH).collect()}
    for r in docs.collect():
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert got[r.doc_id] == want and back[r.doc_id] == library.decode(want, skip_special_tokens=False)


def test_odd_rows(spark, library, odd_documents, no_documents):
    ids = bpe_encode(odd_documents, PATH, keep=("doc_id", "ids"), ids_col="tokens").drop("ids")
    rows = ids.collect()
    texts = {r.doc_id: r.text for r in odd_documents.collect()}
    assert len(rows) == 15 and all(r.tokens == library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids for r in rows)
    back = {r.doc_id: r.text for r in bpe_decode(ids, PATH, ids_col="tokens").collect()}
    assert back == {i: t or "" for i, t in texts.items()}
    assert bpe_encode(no_documents, PATH).count() == 0


def test_ids_that_are_no_tokens(spark, library):
    rows = spark.createDataFrame([(1, [15496, None, -3, 99999999, 50256]), (2, None), (3, []), (4, [447, 247, 447])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in bpe_decode(rows, PATH).collect()}
    assert got == {1: "Hello<|endoftext|>", 2: "", 3: "", 4: library.decode([447, 247, 447], skip_special_tokens=False)}


def test_long_runs_of_one_letter(library):
    texts = ["a" * n for n in (1, 2, 3, 7, 64, 1001)] + ["ab" * 500, " " * 333 + "x", "\n" * 50]
    ids, sizes = Encoder(load_vocabulary(PATH)).encode(texts)
    assert ids.tolist() == [i for t in texts for i in library.encode(t, add_special_tokens=False).ids] and len(sizes) == len(texts)


def test_very_long_words(library):
    """A megabyte without a break: random letters, one letter, digits of base 64, and a short period."""
    rng = random.Random(7)
    letters = lambda n, of: "".join(rng.choices(of, k=n))
    texts = [letters(1_000_000, "abcdefghijklmnopqrstuvwxyz"), "z" * 100_000, letters(50_000, "漢字かな交じり文"), " " * 70_000 + "x", "abcab" * 20_000,
             "é" * 301, letters(201, "ab"), letters(200, "ab")]
    started = time.monotonic()
    ids, sizes = Encoder(load_vocabulary(PATH)).encode(texts)
    assert time.monotonic() - started < 60 and len(sizes) == len(texts)
    assert ids.tolist() == [i for t in texts for i in library.encode(t, add_special_tokens=False).ids]


def test_linked_merges_equal_rounds():
    v, rng = load_vocabulary(PATH), random.Random(3)
    words = [bytes(rng.choices(b"aaabbcde th1-\xc3\xa9", k=rng.randint(1, 90))) for _ in range(500)]
    assert [x.tolist() for x in merge_long(words, v)] == [x.tolist() for x in merge_words(words, v)]
