import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from llm_fixtures import SF_CHECK, no_documents, odd_documents  # noqa: F401
from tokenizers import Tokenizer

from rxcast.llm.alignment import align_tokens, byte_level, overlaps, path_cuts, piece_level
from rxcast.llm.bpe import byte_chars, load_vocabulary
from rxcast.llm.queries import PIECES, QUERIES, VOCABULARY

ZERO = (0, 0, 0, 0, 0, 0, "")


@pytest.fixture(scope="module")
def tokens():
    """Ids and bytes of a text by either library, one token at a time."""
    a = Tokenizer.from_file(VOCABULARY)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    of = {c: i for i, c in enumerate(byte_chars())}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if p.startswith("<0x") and p.endswith(">") and len(p) == 6 else p.replace("▁", " ").encode()

    def both(text):
        x = a.encode(" " + text, add_special_tokens=False).ids
        y = b.encode(text)
        return [(i, bytes(of[c] for c in a.id_to_token(i))) for i in x], [(i, piece(i)) for i in y]
    return both


def brute(texts, tokens):
    """Two pointers over one text after the other."""
    rows, links = [], []
    for text in texts:
        a, b = tokens(text) if text else ([], [])
        want = b" " + (text or "").encode()
        if not text or b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            rows.append((0, 0, 0, ""))
            links.append([])
            continue
        at = {}
        for side, ts in enumerate((a, b)):
            end = 0
            for i, x in ts:
                end += len(x)
                at.setdefault(end, [None, None])[side] = i
        groups, mine, part = [], [], ([], [])
        for _, (i, j) in sorted(at.items()):
            if i is not None:
                part[0].append(i)
            if j is not None:
                part[1].append(j)
            if i is not None and j is not None:
                mine.append((i, j))
                groups.append(",".join(map(str, part[0])) + "|" + ",".join(map(str, part[1])))
                part = ([], [])
        rows.append((len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        links.append(mine)
    count = Counter(p for m in links for p in m)
    most = defaultdict(int)
    for (_, j), n in count.items():
        most[j] = max(most[j], n)
    return [(*r[:3], len(m), sum(count[p] == most[p[1]] for p in m), sum(count[p] for p in m), r[3]) for r, m in zip(rows, links, strict=True)]


def as_rows(df):
    return [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()]


def test_whole_table_against_two_pointers(spark, tokens):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([d.doc_id for d in docs], brute([d.text for d in docs], tokens), strict=True))
    got = QUERIES["op11_merge_path_alignment"](spark, SF_CHECK)
    ids = [r.doc_id for r in got.collect()]
    assert len(ids) == len(docs) and dict(zip(ids, as_rows(got), strict=True)) == want


def test_odd_rows(spark, tokens, odd_documents, no_documents):
    got = align_tokens(odd_documents, VOCABULARY, PIECES, keep=("doc_id", "ids"))
    texts = [r.text for r in odd_documents.collect()]
    assert sorted(as_rows(got)) == sorted(brute(texts, tokens)) and got.columns[:2] == ["doc_id", "ids"]
    assert as_rows(align_tokens(no_documents, VOCABULARY, PIECES)) == []


def test_texts_that_tokenizers_change(spark, tokens):
    texts = ["a▁b", "<s>x</s> <0x41> <unk>", " ", "  two  spaces ", "tab\tnew\nline", "\x00", "café ﬁ", "x" * 3000, None, "﻿bom   　"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    got = as_rows(align_tokens(docs, VOCABULARY, PIECES).orderBy("doc_id"))
    assert got == brute(texts, tokens) and got[0] == ZERO and got[8] == ZERO


def test_pieces_agree_with_one_merge():
    rng = np.random.default_rng(5)
    for _ in range(300):
        top = int(rng.integers(1, 60))
        a, b = (np.append(np.flatnonzero(rng.random(top - 1) < p) + 1, top) for p in rng.random(2))
        whole = overlaps(a, b, len(a) + len(b) + 1)
        union = sorted({*a.tolist(), *b.tolist()})
        assert [x.tolist() for x in whole] == [np.searchsorted(a, union).tolist(), np.searchsorted(b, union).tolist(),
                                               [e in a and e in b for e in union]]
        for piece in (1, 2, 3, 7):
            assert [x.tolist() for x in overlaps(a, b, piece)] == [x.tolist() for x in whole]
            i, j = path_cuts(a, b, piece)
            assert (np.diff(i + j)[:-1] == piece).all() and i[-1] == len(a) and j[-1] == len(b)
    none = np.zeros(0, np.int64)
    assert [len(x) for x in overlaps(none, none)] == [0, 0, 0]


def test_bytes_of_ids():
    with open(PIECES, "rb") as f:
        for c in (byte_level(load_vocabulary(VOCABULARY)), piece_level(f.read())):
            ids, counts = c.cut(["one two", "", "漢\U0001f600"])
            data = b"".join(c.bytes[c.starts[i]:c.starts[i] + c.sizes[i]].tobytes() for i in ids.tolist())
            assert data.replace(b" ", b"") == "onetwo漢\U0001f600".encode() and len(counts) == 3
