import hashlib
import random
import re

from tabularium.llm import substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width):
    owner, out = {}, []
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in words:
        for k in range(len(w) - width + 1):
            s = tuple(w[k : k + width])
            if i is not None:
                owner[s] = min(owner.get(s, i), i)
    for i, w in words:
        gone = set()
        for k in range(len(w) - width + 1):
            if i is not None and owner[tuple(w[k : k + width])] < i:
                gone.update(range(k, k + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def rows_with_passages(seed):
    rng = random.Random(seed)
    words = ["a", "b", "ü", "C", "x1"]
    passages = [[rng.choice(words) for _ in range(rng.randint(3, 30))] for _ in range(6)]
    rows = [(None, " ".join(passages[0] * 3)), (0, None), (1, ""), (-5, "one")]
    for i in range(60):
        text = []
        for _ in range(rng.randint(1, 5)):
            text += rng.choice(passages) if rng.random() < 0.7 else [f"u{rng.randrange(10**6)}" for _ in range(rng.randint(1, 20))]
        rows.append((i - 20, rng.choice([" ", "\n", "  "]).join(text)))
    rows += [rows[10], (99, rows[12][1])]
    return rows


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD_BYTES", 500)
    for seed, width in ((1, 5), (2, 13)):
        rows = rows_with_passages(seed)
        docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as shard").repartition(4)
        got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substrings.remove_repeats(docs, width).collect())
        assert got == brute(rows, width)


def test_matches_sql(same_as_sql):
    same_as_sql("op3_repeated_passages")


def test_rewrite_keeps_columns_and_untouched_texts(spark):
    shared = " ".join(f"s{k}" for k in range(20))
    rows = [(1, "keep\nthis " + shared, "x"), (2, shared + " own\nwords", "y"), (3, "un\ntouched", "z"), (4, None, None)]
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, id string"), rewrite=True)
    assert got.columns == ["doc_id", "text", "id"]
    assert sorted(map(tuple, got.collect())) == [(1, rows[0][1], "x"), (2, "own words", "y"), (3, "un\ntouched", "z"), (4, None, None)]


def test_empty_and_long(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.remove_repeats(docs).count() == 0 and substrings.remove_repeats(docs, rewrite=True).count() == 0
    long = " ".join(f"w{k}" for k in range(120_000))
    got = substrings.remove_repeats(spark.createDataFrame([(5, long), (8, long), (2, "tail w7 w8")], "doc_id int, text string")).collect()
    assert {r.doc_id: (r.n_words, r.n_removed) for r in got} == {5: (120_000, 0), 8: (120_000, 120_000), 2: (3, 0)}
