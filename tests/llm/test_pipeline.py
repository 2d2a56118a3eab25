import re

import pyarrow as pa

import corpus_pipeline
from tabularium.llm import quality
from test_decontaminate import lcs
from test_jaccard import brute as classes
from test_substrings import brute as passages

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages_against_brute_force(spark, data):
    start = spark.read.parquet(f"{data}/documents.parquet")
    docs = start
    bench = [[x.lower() for x in WORD.findall(r.text)] for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        after = stage(spark, docs, data)
        rows = after.collect()
        if name != "packing":
            assert after.columns == start.columns
        if name == "quality":
            verdict = quality.judge(pa.array([r.text for r in before]))["kept"]
            assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r, k in zip(before, verdict) if k)
        elif name == "near_duplicates":
            groups = classes([(r.doc_id, r.text) for r in before], 5, 80)
            assert sorted(r.doc_id for r in rows) == sorted({c for _, c in groups.values()})
        elif name == "repeated_passages":
            want = {i: (n, lost) for i, n, lost, _ in passages([(r.doc_id, r.text) for r in before], 13)}
            assert {str(r.doc_id) for r in rows} == {i for i, (n, lost) in want.items() if n > lost}
            assert all(len(WORD.findall(r.text)) == want[str(r.doc_id)][0] - want[str(r.doc_id)][1] and r.n_chars == len(r.text) for r in rows)
        elif name == "decontamination":
            gone = {r.doc_id for r in before} - {r.doc_id for r in rows}
            for r in before:
                text = [x.lower() for x in WORD.findall(r.text)]
                joined = " " + " ".join(text) + " "
                verbatim = any(" " + " ".join(w) + " " in joined for w in bench)
                assert not verbatim or r.doc_id in gone
                assert r.doc_id not in gone or any(10 * lcs(w, text) >= 7 * len(w) for w in bench)
        else:
            assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in before)
        docs = spark.createDataFrame(rows, after.schema) if name != "packing" else docs
    got = corpus_pipeline.run(spark, data)
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in rows)


def test_documents_without_a_word_left_stay(spark, data):
    passage = " ".join(f"word{k}" for k in range(20))
    rows = [(1, passage, "en", "a", len(passage)), (2, passage, "en", "a", len(passage)), (3, "", "en", "a", 0), (4, None, "en", "a", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.repeated_passages(spark, docs, data)
    assert sorted((r.doc_id, r.text, r.n_chars) for r in left.collect()) == [(1, passage, len(passage)), (2, "", 0), (3, "", 0), (4, None, None)]
    packed = corpus_pipeline.packing(spark, corpus_pipeline.decontamination(spark, left, data), data)
    assert sorted(r.doc_id for r in packed.collect()) == [1, 2, 3, 4]
