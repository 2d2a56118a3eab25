import random
import re

import numpy as np
import pytest

from tabularium.llm import jaccard
from tabularium.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(t or "")]
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(seed, groups=12):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    passage = [f"p{k}" for k in range(40)]
    rows, i = [(0, None), (1, ""), (2, " \n"), (3, "one two"), (4, "One TWO"), (5, "one two three four")], 6
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, 90))]
        if rng.random() < 0.5:
            base += passage
        for _ in range(rng.randint(1, 14)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randint(0, 1)] = [rng.choice(vocabulary).upper()]
            rows.append((i, " ".join(copy)))
            i += 1
    return rows


@pytest.mark.parametrize("seed, width, percent", [(1, 4, 85), (2, 5, 80), (3, 2, 60)])
def test_against_brute_force(spark, seed, width, percent):
    rows = near_copies(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "2 as id").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_documents(docs, width, percent).collect()}
    assert got == brute(rows, width, percent)


def test_matches_sql(same_as_sql):
    same_as_sql("op6_ngram_jaccard")


def test_repeated_rows_null_ids_and_long_texts(spark):
    long = " ".join(f"x{k}" for k in range(60_000))
    rows = [(7, long), (7, long), (None, long), (9, long + " tail"), (None, "alone here now yes"), (None, None)]
    got = jaccard.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == sorted([
        ("7", 59_997, "7"), ("7", 59_997, "7"), ("None", 59_997, "7"), ("9", 59_998, "7"), ("None", 1, "None"), ("None", 0, "None"),
    ])


def test_empty(spark):
    assert jaccard.link_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bitmaps_bound_the_overlap():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (rng.choice(400, rng.integers(1, 200), replace=False) for _ in "ab")
        maps = [np.zeros(4, np.uint64), np.zeros(8, np.uint64)]
        for row, values in zip(maps, (a, b)):
            for v in values:
                row[(v % (64 * len(row))) // 64] |= np.uint64(1) << np.uint64(v % 64)
        assert jaccard.overlap_bound(*maps, len(a), len(b)) >= len(set(a) & set(b))


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(500, k) for k in range(501, 560)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}
    for a, b in edges:
        root.setdefault(a, {a}), root.setdefault(b, {b})
        if root[a] is not root[b]:
            root[a] |= root[b]
            for x in root[b]:
                root[x] = root[a]
    assert {k: min(v) for k, v in root.items() if len(v) > 1 and k != min(v)} == got


def test_frequent_shingles_do_not_depend_on_partitions(spark):
    """A template dealt two documents to a task is found as it is in one task."""
    template = " ".join(f"t{k}" for k in range(20))
    docs = spark.createDataFrame([(i, f"{template} own{i} word{i}") for i in range(40)], "doc_id long, text string")
    for parts in (1, 20):
        dealt = docs.repartitionByRange(parts, "doc_id")
        assert len(jaccard.frequent_shingles(dealt, 4, 1_000)) == 17, parts
    assert len(jaccard.frequent_shingles(docs, 4, 5)) == 5


def test_heavy_counters_keep_what_is_frequent():
    rng = np.random.default_rng(3)
    often, held, counts = np.arange(3, dtype=np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for _ in range(20):
        found = [rng.integers(1_000, 1 << 40, 200).astype(np.uint64), np.repeat(often, 30)]
        held, counts = jaccard.heavy(held, counts, found, 50)
    assert len(held) <= 50 and set(often) <= set(held)
    assert all(600 - 20 * 290 / 50 <= counts[held == k][0] <= 600 for k in often)


def test_tiles_of_many_blocks(spark, monkeypatch):
    """Blocks of two members give the links that one block gives."""
    rows = near_copies(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(jaccard, "TILE_ROWS", 2)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_documents(docs, 4, 85).collect()}
    assert got == brute(rows, 4, 85)


def test_blocks_yield_only_links_that_join_components(spark):
    """40 equal sets in 40 components and 10 that pass the brief bitmaps only: 39 links, not 1,225 pairs."""
    brief = bytes(jaccard.BRIEF // 8)
    equal = np.array([11, 22, 33, 44], np.uint64).tobytes()
    rows = [(7, 0, a, 4, a, True, a > 0, 1, brief, equal) for a in range(40)]
    rows += [(7, 0, a, 4, a, True, True, 1, brief, np.arange(4 * a, 4 * a + 4, dtype=np.uint64).tobytes()) for a in range(40, 50)]
    schema = "shingle long, tile int, a long, n long, component long, own boolean, outside boolean, groups long, brief binary, shingles binary"
    pairs = jaccard._paired(spark.createDataFrame(rows, schema), 85)
    got = pairs.collect()
    assert len(got) == 39 and all(r.a < 40 and r.b < 40 for r in got)
    assert {r.id: r.component for r in components(pairs).collect()} == {a: 0 for a in range(1, 40)}
