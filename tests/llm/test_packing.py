import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tabularium.llm import packing, queries


def test_boundaries_are_optimal():
    rng = random.Random(4)
    for _ in range(30):
        lengths = sorted(rng.sample(range(1, 60), rng.randint(1, 8)))
        counts = np.array([rng.randint(1, 9) for _ in lengths], float)
        sizes = np.array(lengths, float)

        def padding(lasts):
            start, total = 0, 0.0
            for last in lasts:
                total += ((sizes[last] - sizes[start : last + 1]) * counts[start : last + 1]).sum()
                start = last + 1
            return total

        n = len(lengths)
        for k in (1, 2, 3):
            got = packing.boundaries(counts, counts * sizes, sizes, k)
            assert got[-1] == n - 1 and len(got) <= k
            every = [(*c, n - 1) for j in range(k) for c in itertools.combinations(range(n - 1), j)]
            assert padding(got) == min(map(padding, every))
    assert packing.boundaries(np.array([]), np.array([]), np.array([]), 3) == []


def test_cells_keep_order_and_stay_few(spark):
    rows = [r.c for r in spark.range(1, 200_000).select(packing.cell(F.col("id")).alias("c")).collect()]
    assert rows == sorted(rows) and rows[:256] == list(range(1, 257)) and len(set(rows)) < 900


def test_every_document_once_within_budget(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = packing.pack(docs, budget=2048, group_rows=50).collect()
    words = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) + 1 for r in docs.collect()}
    assert {r.doc_id: r.length for r in rows} == words and len(rows) == len(words)
    batches = defaultdict(list)
    for r in rows:
        assert r.length + r.padding == r.padded_length and r.padding >= 0
        batches[r.batch].append(r)
    for b in batches.values():
        assert len({r.padded_length for r in b}) == 1
        assert sorted(r.slot for r in b) == list(range(len(b)))
        assert len(b) == 1 or len(b) * b[0].padded_length <= 2048
    assert len({r.bucket for r in rows}) <= packing.BUCKETS


def test_nulls_repeats_long_and_clashing_columns(spark):
    docs = spark.createDataFrame(
        [(1, None, 1), (2, "", 2), (2, "", 2), (None, "a b", 3), (3, "w " * 100_000, 4)], "doc_id long, text string, bucket int"
    )
    rows = packing.pack(docs, budget=16).collect()
    assert Counter(r.length for r in rows) == {1: 3, 3: 1, 100_001: 1}
    assert len({(r.batch, r.slot) for r in rows}) == 5
    assert packing.pack(docs.limit(0)).count() == 0


def test_registered(spark, data):
    assert queries.QUERIES["op10_packing"](spark, data).count() == spark.read.parquet(f"{data}/documents.parquet").count()
