import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tabularium.llm import collocations as c


def brute(rows, least, top):
    """rows of (text, lang) -> the contract's rows."""
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang, text = lang or "und", "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    able = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    out = {}
    for (lang, words), a in able.items():
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        inside = any(
            q[0] == lang and len(q[1]) > len(words) and b >= a
            and any(q[1][i : i + len(words)] == words for i in range(len(q[1]) - len(words) + 1))
            for q, b in able.items()
        )
        if not inside:
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), a, left, right))
    return {
        (lang, k, p.decode(), a, left, right, totals[lang], -score)
        for lang, all_ in out.items()
        for k, (score, _, p, a, left, right) in enumerate(sorted(all_)[:top], 1)
    }


def mined(spark, rows, least, top, parts=3):
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(parts)
    return {tuple(r) for r in c.collocations(docs, least, top).collect()}


def texts(seed, n):
    rng = random.Random(seed)
    bits = ["in the", "New  York", "new york city", "a", "b", "a b a b", "é", "und", "of\tcourse", ".", ", ", "\n", "!", "straße", "x y"]
    return [(" ".join(rng.choice(bits) for _ in range(rng.randint(0, 30))), rng.choice(["en", "de", None, "und"])) for _ in range(n)]


@pytest.mark.parametrize("seed,least,top", [(1, 4, 1000), (2, 9, 5), (3, 2, 50)])
def test_equals_brute_force(spark, seed, least, top):
    rows = texts(seed, 120)
    assert mined(spark, rows, least, top) == brute(rows, least, top)


def test_many_small_shards_and_crowded_filters_change_nothing(spark, monkeypatch):
    rows = texts(4, 150)
    want = brute(rows, 3, 1000)
    monkeypatch.setattr(c, "SHARD", 7)
    monkeypatch.setattr(c, "VECTOR", 3)
    monkeypatch.setattr(c, "FILTER_BITS", 8)
    monkeypatch.setattr(c, "KEPT", 16)
    monkeypatch.setattr(c, "SLICE_BYTES", 64)
    assert mined(spark, rows, 3, 1000, 5) == want


def test_registered_equals_sql(same_as_sql):
    same_as_sql("op12_collocations")


def test_large_counts_are_scored_exactly(spark):
    own = [(7, 9, [1, 2], [1], [2])]
    found = spark.createDataFrame(own, "key long, whole long, words array<long>, heads array<long>, tails array<long>")
    big = 3 * 10**12 + 1
    counts = spark.createDataFrame([(7, big), (1, big + 5), (2, big + 9), (9, 10**13)], "key long, n long")
    row = c.scored(found, counts, counts.where("key = 7"), 5).first()
    assert row.score == 1000 * big * 10**13 // ((big + 5) * (big + 9))


def test_trie_walks_all_positions(monkeypatch):
    rng = np.random.default_rng(5)
    batch = pa.RecordBatch.from_pydict({"text": [" ".join(rng.choice(list("abcdefgh"), 400)), "a b. c", None], "lang": ["en", "en", "en"]})
    p = c.split(batch)
    phrases = {tuple(p.keys[i : i + k]) for k in (2, 3, 4) for i in rng.integers(0, 390, 60)}
    words = [np.array(x, np.uint64) for x in sorted(phrases)]
    trie = c.build_trie(np.arange(len(words), dtype=np.uint64), words)
    got = Counter()
    for states in trie.walk(p):
        got.update(trie.accepts[states[trie.accepts[states] >= 0]].tolist())
    want = Counter()
    for i in range(len(p.keys)):
        for k in (2, 3, 4):
            if p.left[i] >= k and tuple(p.keys[i : i + k]) in phrases:
                want[sorted(phrases).index(tuple(p.keys[i : i + k]))] += 1
    assert got == want
    used = trie.check[trie.check >= 0]
    assert len(used) == len({tuple(x[:k]) for x in phrases for k in range(1, len(x) + 1)})


def test_nulls_repeats_long_and_clashing_columns(spark):
    long = "alpha beta gamma. " * 30_000
    rows = [(None, None, 1, "x"), ("", "en", 1, "x"), ("A b", None, 2, None), ("a B", "und", 2, None), (long, "en", 3, "key")]
    docs = spark.createDataFrame(rows, "text string, lang string, n long, phrase string")
    got = sorted(map(tuple, c.collocations(docs, 2, 10).collect()))
    assert got == [("en", 1, "alpha beta gamma", 30_000, 30_000, 30_000, 90_000, 3000), ("und", 1, "a b", 2, 2, 2, 4, 2000)]
    assert c.collocations(docs.limit(0)).count() == 0
    assert c.collocations(docs, 10**6).count() == 0
