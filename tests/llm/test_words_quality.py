import os
import re
from collections import Counter

import pyarrow as pa
import pytest

from tabularium.llm import quality, words as W

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    None, "", " ", "\n\n", "one", "a b a b a b a b", "x\ty z  w\r\nx", "été été\nété été\n \nété été",
    "a\nb\na\na\n", "#*$ %&| <> plain", " em space ", "ABC abc", "end\n", "\nstart", "same line\nsame line ",
]


def brute(text):
    text = text or ""
    found = WORD.findall(text)
    three = Counter(zip(found, found[1:], found[2:]))
    hit = {k + j for k in range(len(found) - 2) if three[tuple(found[k : k + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), dup, len(hit))


def test_words_are_those_of_the_pattern():
    w = W.split(pa.array(TEXTS))
    got = [[w.text(a, b) for a, b in zip(w.starts[i:j], w.ends[i:j])] for i, j in zip(w.first, w.first[1:])]
    assert got == [WORD.findall(t or "") for t in TEXTS]


def test_equal_words_and_windows_hash_alike():
    w = W.split(pa.array(["a b c d", "x a b c d", "A B c d"]))
    plain, folded = W.hashes(w), W.hashes(w, fold=True)
    assert list(plain[:4]) == list(plain[5:9]) and plain[0] != plain[9] and list(folded[:4]) == list(folded[9:])
    at, found = W.windows(w, plain, 3)
    assert list(w.doc[at]) == [0, 0, 1, 1, 1, 2, 2] and found[0] == found[3] and found[1] == found[4]


def test_statistics_match_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(TEXTS)], docs.schema)
    rows = docs.unionByName(extra).unionByName(docs.limit(3)).collect()
    frame = spark.createDataFrame(rows, docs.schema).withColumnRenamed("text", "n_words").selectExpr("*", "1 AS kept", "doc_id AS _key")
    got = Counter(tuple(r)[:6] for r in quality.quality_rules(frame, "n_words").collect())
    assert got == Counter((i, *brute(t)) for i, t in rows)


@pytest.mark.parametrize("text, reason", [
    (None, "few words"), ("word " * 49, "few words"), ("same " * 60, "repeated words"),
])
def test_base_rules(text, reason):
    found = quality.judge(pa.array([text], pa.string()))
    assert found["reason"] == [reason] and found["base_failed"][0] and not found["kept"][0]


def test_bands_reject_noise_and_repeats_and_keep_prose(spark, data):
    import random

    rng = random.Random(3)
    noise = " ".join("".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(9)) for _ in range(80))
    loop = " ".join(f"prefix{i}suffix" for i in range(900))
    found = quality.judge(pa.array([noise, loop]))
    assert found["reason"][0] == "incompressible" and found["reason"][1].startswith("repet")
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    good = quality.keep_good(docs.join(labels.where("quality = 1"), "doc_id", "left_semi"))
    assert good.columns == docs.columns
    total = quality.quality_rules(docs).join(labels.where("quality = 1"), "doc_id", "left_semi").where("n_words >= 50 and not base_failed")
    assert good.count() >= 0.97 * total.count() > 0


@pytest.mark.parametrize("size", [200_000, 1_000_000])
def test_long_prose_is_kept(size):
    import random

    rng = random.Random(5)
    syllables = [a + b for a in "bcdfglmnprst" for b in ("a", "e", "i", "o", "un", "er")]
    known = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(3_000)]
    weights = [1 / (k + 3) for k in range(len(known))]
    text = " ".join(w + "." * (k % 11 == 0) for k, w in enumerate(rng.choices(known, weights, k=size // 4)))[:size]
    ratio, reason = quality.compression_reason(text.encode(), quality.zstandard.ZstdCompressor(level=quality.LEVEL))
    assert len(text) == size and ratio < 0.385 and reason is None


def test_prose_of_people_is_kept():
    path = "/usr/share/common-licenses/GPL-3"
    if not os.path.exists(path):
        pytest.skip("no licence text on this machine")
    found = quality.judge(pa.array([open(path, encoding="utf-8").read()]))
    assert found["kept"][0] and found["ratio"][0] < 0.385


def test_least_ratio_falls_with_every_length():
    floors = [quality.whole_band(2**k)[0] for k in range(8, 40)]
    assert all(a >= b for a, b in zip(floors, floors[1:])) and all(a > b for a, b in zip(floors[3:17], floors[4:18]))
    passage = " ".join(f"w{k * 7919 % 10007:x}" for k in range(1_500)).encode()
    assert quality.compression_reason(passage * 40, quality.zstandard.ZstdCompressor(level=quality.LEVEL))[1] == "repetitive"


def prose_of(size):
    import random

    rng = random.Random(size)
    known = ["".join(rng.choices("abcdefgimnoprstu", k=rng.randint(2, 9))) for _ in range(900)]
    return " ".join(rng.choices(known, [1 / (k + 40) for k in range(900)], k=size)).encode()[:size]


@pytest.mark.parametrize("clean, noisy", [(12_000, 18_000), (15_000, 15_000), (24_000, 6_000), (4_096, 2_047), (900, 1_000), (300, 600)])
def test_noise_in_part_of_a_text(clean, noisy):
    import base64
    import random

    rng = random.Random(clean)
    lines = b"\n".join(base64.b64encode(rng.randbytes(57)) for _ in range(noisy // 77 + 1))[:noisy]
    squeeze = quality.zstandard.ZstdCompressor(level=quality.LEVEL)
    assert quality.compression_reason(prose_of(clean), squeeze)[1] is None
    assert quality.compression_reason(prose_of(clean) + b"\n" + lines, squeeze)[1].startswith("incompressible")


def test_random_letters_in_half_of_a_text_are_noise():
    import random

    rng = random.Random(4)
    letters = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(15_000)).encode()
    squeeze = quality.zstandard.ZstdCompressor(level=quality.LEVEL)
    assert quality.compression_reason(prose_of(15_000) + letters, squeeze)[1] == "incompressible chunks"


def test_pieces_reach_the_end():
    for n in (0, 4, 5, 6, 9, 10, 11, 23):
        text = bytes(range(n))
        got = quality.pieces(text, 5)
        assert all(len(p) == 5 for p in got) and len(got) == (-(-n // 5) if n >= 5 else 0)
        assert n < 5 or (set(b"".join(got)) == set(text) and got[-1] == text[-5:])


def test_empty_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(0)
    assert quality.quality_rules(docs).count() == 0 and quality.keep_good(docs).count() == 0


def test_slices_without_a_reason_keep_their_type(spark, data):
    good = spark.read.parquet(f"{data}/documents.parquet").where("n_chars > 2000").limit(5)
    short = spark.createDataFrame([(1, "x" * (3 << 20)), (2, "few words"), (3, None)], "doc_id long, text string")
    assert quality.quality_rules(good.select("doc_id", "text").union(short)).count() == 8
