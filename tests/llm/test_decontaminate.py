import random
import re

from tabularium.llm import decontaminate, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for k, y in enumerate(b):
            new.append(row[k] + 1 if x == y else max(row[k + 1], new[k]))
        row = new
    return row[-1]


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randint(0, 30))] for _ in "ab")
        assert decontaminate.common_subsequence(a, b) == lcs(a, b)


def test_paraphrases_are_found_and_clean_texts_left(spark):
    rng = random.Random(2)
    words = [f"w{k}" for k in range(3000)]
    common = ["the", "of", "and", "to"]

    def prose(n):
        return [rng.choice(common) if rng.random() < 0.4 else rng.choice(words) for _ in range(n)]

    items = [(k, " ".join(prose(rng.randint(15, 60)))) for k in range(12)] + [(90, None), (91, "")]
    rows, planted = [], set()
    for i in range(150):
        text = prose(rng.randint(0, 400))
        if i % 5 == 0:
            item, source = rng.choice(items[:12])
            copy = [x.upper() if rng.random() < 0.3 else x for x in source.split() if rng.random() > 0.1]
            at = rng.randint(0, len(text))
            text[at:at] = copy
            planted.add((i, item))
        rows.append((i, " ".join(text), 1))
    rows += [(500, None, 1), (501, "", 1), (None, items[3][1], 1), (502, items[4][1], 1), (502, items[4][1], 1), (503, " ".join(prose(150_000)) + " " + items[5][1], 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [*planted, (None, 3), (502, 4), (502, 4), (503, 5)]))
    left = decontaminate.drop_leaks(docs, bench)
    assert left.columns == docs.columns and left.count() == docs.count() - len(got)


def test_every_verbatim_item_is_found(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    items = [(r.item_id, [x.lower() for x in WORD.findall(r.text)]) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    verbatim = set()
    for d in docs:
        text = " " + " ".join(x.lower() for x in WORD.findall(d.text or "")) + " "
        verbatim |= {(d.doc_id, i) for i, w in items if " " + " ".join(w) + " " in text}
    got = {(r.doc_id, r.item_id) for r in queries.QUERIES["op2_decontamination"](spark, data).collect()}
    assert verbatim and verbatim <= got and len(got) <= 1.2 * len(verbatim) + 1


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "some words here")], "item_id long, text string")
    assert decontaminate.find_leaks(docs, bench).count() == 0
    some = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    assert decontaminate.find_leaks(some, bench.limit(0)).count() == 0
    assert decontaminate.drop_leaks(some, bench).count() == 0


def test_windows_without_enough_item_words_skip_the_subsequence(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from tabularium.llm import words as W

    item = " ".join(f"item{k}" for k in range(20))
    w = W.split(pa.array([item], pa.string()))
    hashed = W.hashes(w, fold=True)
    terms = np.unique(hashed)
    latent = np.ones((1, len(terms)), np.float32) / np.sqrt(len(terms))
    space = decontaminate.Space([7], [[int(h) for h in hashed]], terms, np.ones(len(terms)), np.eye(len(terms), dtype=np.float32), latent)
    half = " ".join(f"item{k}" for k in range(10)) + " other words here"
    texts = pa.array([half, "lead in " + item + " and more"], pa.string())
    calls = []
    plain = decontaminate.common_subsequence
    monkeypatch.setattr(decontaminate, "common_subsequence", lambda a, b: calls.append(1) or plain(a, b))
    w = W.split(texts)
    found = decontaminate.leaks(w, W.hashes(w, fold=True), space)
    assert list(found) == [(1, 0)] and found[1, 0][0] == 20
    assert len(calls) == 2  # the leak and its answer; the half passage is bounded out


def test_blocks_share_one_frequency_pass(spark, monkeypatch):
    import numpy as np

    texts = [" ".join(f"w{(d * 7 + k) % 500}" for k in range(90)) for d in range(60)]
    docs = spark.createDataFrame([(d, t) for d, t in enumerate(texts)], "doc_id long, text string")
    items = [(k, " ".join(f"w{(k * 3 + j) % 500}" for j in range(12))) for k in range(decontaminate.BLOCK + 5)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    plain = decontaminate._frequencies
    calls = []
    monkeypatch.setattr(decontaminate, "_frequencies", lambda d, t: calls.append(len(t)) or plain(d, t))
    spaces = decontaminate._spaces(docs, bench)
    assert len(calls) == 1 and len(spaces) == 2
    for space, k in zip(spaces, (0, decontaminate.BLOCK)):
        alone = decontaminate.fit(docs.select("text"), items[k : k + decontaminate.BLOCK])
        assert np.array_equal(space.terms, alone.terms) and np.array_equal(space.idf, alone.idf)
        assert np.allclose(space.basis, alone.basis) and np.allclose(space.latent, alone.latent)
