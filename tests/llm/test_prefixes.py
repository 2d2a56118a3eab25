import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from tabularium.llm import prefixes


def brute(rows):
    """rows of (conv_id, turn, role, text) -> the contract's rows."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        if conv is not None:
            sha = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, int(sha[:15], 16), int(sha[15:30], 16)), (role, text)))
    own = {c: [t for _, t in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]  # remainders have the sign of the id
    nodes = defaultdict(list)
    for c, turns in sorted(built.items()):
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in nodes:
        if path:
            children[path[:-1]].append(path)
    out = set()

    def subtree(path):
        todo = [path]
        while todo:
            one = todo.pop()
            yield one
            todo += children[one]

    for path, members in nodes.items():
        below = list(subtree(path))
        ends = ",".join(str(c) for c in members if len(built[c]) == len(path))
        out.add((
            members[0], len(path), nodes[path[:-1]][0] if path else None, len(members), len(children[path]),
            sum(not children[p] for p in below), sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in below if p),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def found(spark, rows):
    chat = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = [tuple(r) for r in prefixes.prefix_trie(chat.repartition(3)).collect()]
    assert len(got) == len(set(got))
    return set(got)


def made(seed, convs, longest, kinds=2):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(230), convs):
        n = rng.choice([1, 2, longest, rng.randint(1, longest)])
        own = random.Random(rng.randint(0, 3))
        rows += [(c, t, own.choice(["user", None]), own.choice(["", "é", "abc"][: kinds + 1]) if rng.random() < 0.97 else "x") for t in range(n)]
    return rows


@pytest.mark.parametrize("seed,block,span", [(1, 8, 1024), (2, 2, 2), (3, 3, 1), (4, 1, 3)])
def test_equals_brute_force(spark, monkeypatch, seed, block, span):
    monkeypatch.setattr(prefixes, "BLOCK", block)
    monkeypatch.setattr(prefixes, "SPAN", span)
    monkeypatch.setattr(prefixes, "CHUNK_BITS", 3)
    rows = made(seed, 60, 20)
    assert found(spark, rows) == brute(rows)


def test_nulls_ties_and_repeats(spark):
    rows = [
        (None, 1, "user", "lost"), (0, None, None, None), (0, 1, "user", "a"), (0, 1, "user", "b"), (0, 1, "user", "b"),
        (1, 1, "user", "a"), (7, 2, "assistant", "c"), (-3, 1, "user", "a"), (107, 0, "u", "ser"), (108, 0, "us", "er"), (207, None, "x", "y" * 50_000),
    ]
    assert found(spark, rows) == brute(rows)


def test_every_conversation_turnless(spark):
    turnless = [c for c in range(1, 300) if zlib.crc32(str(c).encode()) % 6 >= 2 and c >= 100 and c % 100][:3]
    rows = [(c, 0, "user", "gone") for c in turnless]
    assert found(spark, rows) == brute(rows) and len(brute(rows)) == 1


def test_empty_and_clashing_columns(spark):
    chat = spark.createDataFrame([(5, 0, "user", "a", 1, 2, "x"), (6, 0, "user", "a", 1, 2, "x")],
                                 "conv_id long, turn long, role string, text string, d long, rep long, ends_sha256 string")
    got = {tuple(r) for r in prefixes.prefix_trie(chat).collect()}
    assert got == brute([(5, 0, "user", "a"), (6, 0, "user", "a")])
    assert prefixes.prefix_trie(chat.limit(0)).count() == 0


def test_registered_equals_sql(same_as_sql):
    same_as_sql("op13_prefix_trie")
