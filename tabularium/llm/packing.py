"""Packing into optimal length buckets, with token-budget batches inside each bucket.

The lengths of all documents are counted in a global histogram whose cells are exact up to
``EXACT`` and 1/64 wide (relative) above, so its size is bounded by the largest length, not by
the rows: under 1,700 cells up to 2**31. Dynamic programming over the cells chooses at most
``buckets`` boundaries that minimise the padding of all documents to their bucket's boundary,
which is the largest length seen in its last cell. A batch holds as many documents of one bucket
as fit in ``budget`` padded tokens, one at least. Batches form inside groups of a bucket that a
hash of the id deals out, of about ``GROUP_ROWS`` documents, so that no bucket is one task.

The length is the number of words plus one end mark. Null and empty texts have length 1. Rows
with equal ids and lengths are interchangeable: each takes a slot of its own. Texts longer than
the budget are a batch each. Null ids are dealt like any value. An empty table gives an empty
result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

EXACT = 256
STEPS = 64
BUCKETS = 12
BUDGET = 16_384
GROUP_ROWS = 50_000


def word_length(text):
    """Words of a text column plus one."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long") + 1


def cell(length):
    """Histogram cell of a length column; cells keep the order of lengths."""
    power = F.floor(F.log2(F.greatest(length, F.lit(1)).cast("double") + 0.5)).cast("long")
    base = F.pow(F.lit(2.0), power.cast("double"))
    inside = F.floor((length - base) * STEPS / base).cast("long")
    return F.when(length <= EXACT, length).otherwise(EXACT + (power - int(np.log2(EXACT))) * STEPS + inside + 1).cast("long")


def boundaries(counts: np.ndarray, totals: np.ndarray, largest: np.ndarray, buckets: int) -> list[int]:
    """Index of the last cell of each bucket, with the least padding; fewest buckets on ties."""
    n = len(counts)
    if not n:
        return []
    rows, tokens = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(totals)])
    best = np.full(n + 1, np.inf)
    best[0] = 0
    choice = np.zeros((min(buckets, n), n + 1), np.int64)
    results = []
    for k in range(min(buckets, n)):
        fresh = np.full(n + 1, np.inf)
        for stop in range(1, n + 1):
            cost = best[:stop] + largest[stop - 1] * (rows[stop] - rows[:stop]) - (tokens[stop] - tokens[:stop])
            choice[k, stop] = int(np.argmin(cost))
            fresh[stop] = cost[choice[k, stop]]
        best = fresh
        results.append(best[n])
        best = np.concatenate([[np.inf], best[1:]])
    k = int(np.argmin(results))
    out, stop = [], n
    for level in range(k, -1, -1):
        out.append(stop - 1)
        stop = int(choice[level, stop])
    return out[::-1]


def plan_buckets(lengths: DataFrame, buckets: int = BUCKETS) -> list[tuple[int, int, int]]:
    """(last cell, padded length, documents) of each bucket, from the histogram of all rows."""
    rows = lengths.groupBy(cell(F.col("length")).alias("cell")).agg(
        F.count("*").alias("n"), F.sum("length").alias("total"), F.max("length").alias("largest")
    ).orderBy("cell").collect()
    counts, totals, largest = (np.array([r[c] for r in rows], np.float64) for c in ("n", "total", "largest"))
    out, start = [], 0
    for last in boundaries(counts, totals, largest, buckets):
        out.append((rows[last].cell, rows[last].largest, int(counts[start : last + 1].sum())))
        start = last + 1
    return out


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, group_rows: int = GROUP_ROWS) -> DataFrame:
    """doc_id, length, bucket, padded_length, batch (text), slot and padding of every document."""
    lengths = docs.select("doc_id", word_length(F.col("text")).alias("length"))
    plan = plan_buckets(lengths, buckets)
    place, groups, padded = F.lit(0), F.lit(1), F.lit(1)
    for k, (last, largest, n) in reversed(list(enumerate(plan))):
        here = cell(F.col("length")) <= last
        place = F.when(here, k).otherwise(place)
        padded = F.when(here, largest).otherwise(padded)
        groups = F.when(here, -(-n // group_rows)).otherwise(groups)
    dealt = lengths.select("doc_id", "length", place.alias("bucket"), padded.cast("long").alias("padded_length"), groups.alias("groups"))
    dealt = dealt.withColumn("dealt", F.pmod(F.xxhash64("doc_id", "length"), F.col("groups")))
    # One task sorts many groups; a hash of both keeps the large buckets apart.
    order = Window.partitionBy("bucket", "dealt").orderBy("doc_id", "length")
    fits = F.greatest(F.floor(F.lit(budget) / F.col("padded_length")), F.lit(1)).cast("long")
    dealt = dealt.withColumn("at", F.row_number().over(order).cast("long") - 1)
    return dealt.select(
        "doc_id", "length", "bucket", "padded_length",
        F.format_string("%d-%d-%d", "bucket", "dealt", F.floor(F.col("at") / fits)).alias("batch"),
        (F.col("at") % fits).alias("slot"), (F.col("padded_length") - F.col("length")).alias("padding"),
    )
