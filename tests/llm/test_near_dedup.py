from collections import Counter, defaultdict

import numpy as np
from llm_fixtures import SF_CHECK, no_documents, odd_documents  # noqa: F401

from rxcast.llm.minmax import BANDS, HASHES, band_keys, near_duplicates, shingle_sets, signatures
from rxcast.llm.tables import components


def groups(texts: dict, k: int) -> dict:
    """Brute force: (set size, smallest reachable id) per id."""
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    where, common, root = defaultdict(list), Counter(), {i: i for i in sets}
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    for ids in where.values():
        for a in range(len(ids)):
            for b in range(a):
                common[ids[b], ids[a]] += 1

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_matches_brute_force_on_whole_table(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    want = groups({r.doc_id: r.text for r in docs.collect()}, 4)
    got = near_duplicates(docs, 4, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_odd_rows(spark, odd_documents, no_documents):
    rows = near_duplicates(odd_documents, 4, 80).collect()
    assert len(rows) == 15
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert [by[i].component_id for i in (0, 1, 2, 6, 7, 9)] == [0, 0, 2, 6, 6, 9]
    assert all(by[i].n_shingles == 0 and by[i].kept for i in (3, 4, 5))
    assert by[8].n_shingles == by[9].n_shingles == 1
    alone = [r for r in rows if r.doc_id is None]
    assert len(alone) == 2 and all(r.component_id is None and r.kept for r in alone)
    assert near_duplicates(no_documents).count() == 0


def test_links_between_members_that_are_not_linked_to_the_smallest(spark):
    """A chain and a large group: the second round finds links across components of a band."""
    rng = np.random.default_rng(3)
    base = [f"t{i}" for i in range(100)]
    texts = {}
    for d in range(120):
        w = list(base)
        for j in rng.choice(100, rng.integers(0, 7), replace=False):
            w[j] = f"e{d % 40}x{j}"
        texts[d] = " ".join(w)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, 4, 80).collect()}
    assert got == groups(texts, 4)


def test_ids_with_two_texts_inside_a_large_group(spark):
    """Each text is held under a number of its own by the brute force; those of an id are linked by an equal text."""
    rng = np.random.default_rng(3)
    base, rows = [f"t{i}" for i in range(100)], []
    for d in range(120):
        w = list(base)
        for j in rng.choice(100, rng.integers(0, 7), replace=False):
            w[j] = f"e{d % 40}x{j}"
        rows.append((d, " ".join(w)))
    for i in (0, 7, 30, 61, 90):  # longer and shorter texts of ids that are there, in the group and beside it
        rows.append((i, " ".join([*base, *(f"more{i}x{j}" for j in range(8))])))
        rows.append((i, " ".join(f"far{i}x{j}" for j in range(50))))
    rows += [(200, rows[3][1]), (200, "a text that another id has as well"), (201, "a text that another id has as well")]
    alone = groups(dict(enumerate(t for _, t in rows)), 4)
    root = {n: alone[n][1] for n in range(len(rows))}
    for _ in rows:  # to the smallest over equal ids and equal components
        low = {}
        for n, (i, _) in enumerate(rows):
            for k in (("id", i), ("group", alone[n][1])):
                low[k] = min(low.get(k, root[n]), root[n])
        after = {n: min(low["id", i], low["group", alone[n][1]]) for n, (i, _) in enumerate(rows)}
        if after == root:
            break
        root = after
    name = {r: min(i for n, (i, _) in enumerate(rows) if root[n] == r) for r in set(root.values())}
    want = sorted((i, alone[n][0], name[root[n]]) for n, (i, _) in enumerate(rows))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 80).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert len(set(name.values())) > 1


def test_both_extremes_estimate_similarity():
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(400)]
    a, b = shingle_sets([" ".join(words), " ".join(words[:360] + [f"x{i}" for i in rng.permutation(40)])], 1)
    j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    sig = signatures([a, b])
    assert sig.shape == (2, 2 * HASHES) and abs((sig[0] == sig[1]).mean() - j) < 0.1
    for side in (0, 1):
        assert abs((sig[0, side::2] == sig[1, side::2]).mean() - j) < 0.12
    assert band_keys(sig).shape == (2, BANDS)


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(50)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(51)}}
