import random

import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from tabularium.llm import queries, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_registered_equals_the_library(spark, data):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = queries.QUERIES["op11_token_counts"](spark, data).collect()
    assert len(rows) == len(docs)
    want = dict(zip(docs, library(list(docs.values()))))
    for r in rows:
        assert (r.n_bytes, r.n_tokens) == (len(docs[r.doc_id].encode()), want[r.doc_id])
        assert r.over_limit == (r.n_tokens > 512)


def test_random_texts_equal_the_library(spark):
    rng = random.Random(11)
    bits = ["the", " ", "  ", "\n", "\t", "'s", "'LL", "don't", "12", "½", "é", "ß", "中文", "🙂", " ", "\u0085", "\x1c",
            "<|endoftext|>", "<|endoftext", "|>", "...", "​", "՘", "\U00010940", "ꟍ", "x" * 300, "á", "　"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, PATH).collect()}
    assert [got[k] for k in range(len(texts))] == library(texts)


def test_usual_characters_are_cut_as_the_library_cuts_them():
    own = token_counts.PreTokens(PATH)
    unusual, pattern = regex.compile(token_counts.UNUSUAL), regex.compile(token_counts.PATTERN)
    for code in range(0x110000):
        c = chr(code)
        if 0xD800 <= code < 0xE000 or unusual.match(c):
            continue
        probe = f"a{c}a1{c}1!{c}! {c}{c} b"
        assert [s for _, s in own.tokenizer.pre_tokenizer.pre_tokenize_str(probe)] == [m.span() for m in pattern.finditer(probe)], hex(code)


def test_small_bounds_change_no_count(monkeypatch):
    monkeypatch.setattr(token_counts, "PART", 7)
    monkeypatch.setattr(token_counts, "HELD", 5)
    monkeypatch.setattr(token_counts, "CACHE", 3)
    monkeypatch.setattr(token_counts, "FREQUENT", 2)
    texts = ["", "Some words, 12 of them,  and\n\n more <|endoftext|> words's", "w" * 500 + " " + "word " * 99]
    own = token_counts.Lengths(PATH, [" word", "never"], token_counts.np.array([1, 2], "uint16"))
    for _ in range(3):
        assert own.counts(texts) == library(texts)
    assert len(own.known) <= 2 + 3 + 5 + 1


def test_nulls_repeats_long_and_clashing_columns(spark):
    long = "some words and 12 numbers, " * 40_000
    docs = spark.createDataFrame(
        [(1, None, 1, True), (1, "", 2, True), (None, "a b", 3, None), (2, long, 4, False), (2, long, 4, False)],
        "doc_id long, text string, n_tokens long, over_limit boolean",
    )
    got = token_counts.count_tokens(docs, PATH)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    n = library([long])[0]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(1, 0, 0, False), (1, 0, 0, False), (None, 3, 2, False), (2, len(long), n, True), (2, len(long), n, True)], key=repr
    )
    assert token_counts.count_tokens(docs.limit(0), PATH).count() == 0


def test_other_tokenizers_are_an_error():
    with pytest.raises(ValueError):
        token_counts.PreTokens(public_tokenizers.path("word_bpe_49k.json"))
