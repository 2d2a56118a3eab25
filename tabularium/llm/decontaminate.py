"""Benchmark decontamination by latent semantic retrieval, then alignment of the candidates.

Terms are words and word pairs (A-Z as a-z) of the benchmark items; documents are read as
passages of 64 words that start every 32. Items are handled in blocks of ``BLOCK``, each with a
latent space of its own, so a space always has more dimensions than items:

1. Document frequencies of the block's terms over all half passages; words in more than
   ``MAX_SHARE`` of them weigh nothing, word pairs always count, so that a leak that a third of
   all documents share keeps its weight.
2. Distributed randomised SVD of the TF-IDF passages (with the items as further rows): every
   task adds up its part of A'A times a random matrix, the parts are summed by term blocks, and
   the left singular vectors of the sum span the latent space.
3. Passages and items meet by cosine in that space; pairs of ``COSINE`` or more are candidates.
4. A candidate is a leak if the longest common subsequence of the item and the passage, widened
   by the item's length on both sides, has at least 70 % of the item's words, and that of the
   item's answer (its last quarter) at least half of the answer's words.

Null and empty texts have no passages; items without words match nothing; null ids are carried.
Repeated rows are found alike, ties between items all count. Very long texts are many passages.
Without rows or items the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm import words as W

HALF = 32  # words; a passage is two halves
BLOCK = 192  # items of one latent space
OVERSAMPLE = 32
MAX_SHARE = 0.001  # of half passages, for words; word pairs always count
SLICE_BYTES = 1 << 20
SIEVE_BITS = 20
COSINE = 0.3
LCS_PERCENT, ANSWER_PERCENT = 70, 50
TERM_BLOCK = 256


class Space(NamedTuple):
    ids: list[int]
    items: list[list[int]]  # word hashes of each item
    terms: np.ndarray  # sorted term hashes
    idf: np.ndarray
    basis: np.ndarray  # term x dimension
    latent: np.ndarray  # item x dimension, unit length


def _terms(w: W.Words, hashed: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word and number in ``known`` of every occurrence of a known term."""
    pairs, pair = W.windows(w, hashed, 2)
    at, found = np.concatenate([np.arange(len(hashed)), pairs]), np.concatenate([hashed, pair])
    maybe = np.zeros(1 << SIEVE_BITS, bool)
    maybe[known & np.uint64(len(maybe) - 1)] = True
    likely = np.flatnonzero(maybe[found & np.uint64(len(maybe) - 1)])
    at, found = at[likely], found[likely]
    where = np.minimum(np.searchsorted(known, found), len(known) - 1)
    hit = known[where] == found
    return at[hit], where[hit]


def _halves(w: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Half passage of each word, and the text and first word of each half."""
    place = np.arange(len(w.starts)) - w.first[:-1][w.doc]
    starts = np.flatnonzero(place % HALF == 0)
    return np.cumsum(place % HALF == 0) - 1, w.doc[starts], starts


def _sums(group: np.ndarray, n: int, rows: np.ndarray) -> np.ndarray:
    """Sum of ``rows`` by group."""
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    if len(group):
        order = np.argsort(group, kind="stable")
        group = group[order]
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        out[group[first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, W.Words, np.ndarray]]:
    for batch in batches:
        for part in W.slices(batch, limit=SLICE_BYTES):
            w = W.split(part.column("text"))
            yield part, w, W.hashes(w, fold=True)


def _passages(w: W.Words, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vector of each passage, a half and the next of its text, and the half it starts with."""
    half, doc, _ = _halves(w)
    used, number = np.unique(half[at], return_inverse=True)
    own = _sums(number, len(used), rows)
    follows = np.zeros(len(used), bool)
    follows[1:] = (np.diff(used) == 1) & (doc[used[1:]] == doc[used[:-1]])
    both = own.copy()
    both[:-1][follows[1:]] += own[1:][follows[1:]]
    # A half whose predecessor has no term also ends the passage before it: same vector.
    return both, used


def _frequencies(docs: DataFrame, terms: np.ndarray) -> tuple[np.ndarray, int]:
    """Half passages that have each term, and the number of half passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(terms) + 1, np.int64)
        for _, w, hashed in _slices(batches):
            half, doc, _ = _halves(w)
            at, term = _terms(w, hashed, terms)
            seen = np.unique(half[at] * np.int64(len(terms)) + term) if len(at) else np.zeros(0, np.int64)
            counts[:-1] += np.bincount(seen % len(terms), minlength=len(terms))
            counts[-1] += len(doc)
        some = np.flatnonzero(counts)
        yield pa.record_batch({"term": pa.array(some), "n": pa.array(counts[some])})

    rows = docs.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(len(terms) + 1, np.int64)
    for r in rows:
        found[r.term] = r.n
    return found[:-1], int(found[-1])


def _sketch(docs: DataFrame, terms: np.ndarray, idf: np.ndarray, omega: np.ndarray) -> np.ndarray:
    """A'A omega over the TF-IDF passages A of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(omega.shape)
        for _, w, hashed in _slices(batches):
            at, term = _terms(w, hashed, terms)
            at, term = at[idf[term] > 0], term[idf[term] > 0]
            half = np.unique(_halves(w)[0][at], return_inverse=True)[1]
            weight = idf[term][:, None].astype(np.float32)
            rows = _sums(half, int(half.max(initial=-1)) + 1, weight * omega[term].astype(np.float32))
            total += _sums(term, len(terms), weight * rows[half])
        for k in range(0, len(terms), TERM_BLOCK):
            yield pa.record_batch({"block": pa.array([k]), "part": pa.array([total[k : k + TERM_BLOCK].tobytes()], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column("block").to_pylist(), batch.column("part").to_pylist()):
                part = np.frombuffer(raw)
                sums[k] = sums[k] + part if k in sums else part
        if sums:
            yield pa.record_batch({"block": pa.array(list(sums)), "part": pa.array([x.tobytes() for x in sums.values()], pa.binary())})

    parts = docs.mapInArrow(run, "block long, part binary").repartition("block").mapInArrow(add, "block long, part binary")
    out = np.zeros(omega.shape)
    for r in parts.collect():  # terms x dimensions of one block of items, whatever the rows
        out[r.block : r.block + TERM_BLOCK] = np.frombuffer(r.part).reshape(-1, omega.shape[1])
    return out


def item_terms(items: list[tuple[int, str]]) -> np.ndarray:
    """Sorted hashes of the words and word pairs of the items."""
    w = W.split(pa.array([t for _, t in items], pa.string()))
    hashed = W.hashes(w, fold=True)
    _, pair = W.windows(w, hashed, 2)
    return np.unique(np.concatenate([hashed, pair]))


def fit(docs: DataFrame, items: list[tuple[int, str]], counted: tuple[np.ndarray, np.ndarray, int] | None = None) -> Space | None:
    """The latent space of one block of items over all documents.

    ``counted`` may give sorted terms that hold the block's, with their frequencies and the number
    of half passages, so that blocks share one pass; each term is counted alone, so alike.
    """
    w = W.split(pa.array([t for _, t in items], pa.string()))
    hashed = W.hashes(w, fold=True)
    terms = item_terms(items)
    if not len(terms):
        return None
    if counted is None:
        df, halves = _frequencies(docs, terms)
    else:
        df, halves = counted[1][np.searchsorted(counted[0], terms)], counted[2]
    frequent = (df > max(20, MAX_SHARE * halves)) & np.isin(terms, hashed)
    idf = np.where(frequent, 0.0, np.log((halves + 1) / (df + 1)) + 1)
    at, term = _terms(w, hashed, terms)
    omega = np.random.Generator(np.random.PCG64(5)).standard_normal((len(terms), min(len(terms), len(items) + OVERSAMPLE)))
    own = _sums(w.doc[at], len(items), idf[term][:, None] * omega[term])
    sketch = _sketch(docs, terms, idf, omega) + _sums(term, len(terms), idf[term][:, None] * own[w.doc[at]])
    basis, size, _ = np.linalg.svd(sketch, full_matrices=False)
    basis = np.ascontiguousarray(basis[:, size > 1e-10 * max(size[0], 1e-300)])
    latent = _sums(w.doc[at], len(items), idf[term][:, None] * basis[term])
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
    words = [[int(h) for h in hashed[a:b]] for a, b in zip(w.first, w.first[1:])]
    return Space([i for i, _ in items], words, terms, idf, basis.astype(np.float32), latent.astype(np.float32))


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, with the row of ``a`` as the bits of a number."""
    places: dict[int, int] = {}
    for k, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << k
    every = (1 << len(a)) - 1
    row = every
    for x in b:
        hit = row & places.get(x, 0)
        row = (row + hit | row - hit) & every
    return len(a) - row.bit_count()


def leaks(w: W.Words, hashed: np.ndarray, space: Space) -> dict[tuple[int, int], tuple[int, float]]:
    """(text, item) of every leak in a slice, with its common words and best cosine."""
    at, term = _terms(w, hashed, space.terms)
    at, term = at[space.idf[term] > 0], term[space.idf[term] > 0]
    out: dict[tuple[int, int], tuple[int, float]] = {}
    if not len(at):
        return out
    vectors, used = _passages(w, at, (space.idf[term][:, None] * space.basis[term]).astype(np.float32))
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    cosine = vectors @ space.latent.T
    _, doc, starts = _halves(w)
    for p, i in zip(*np.nonzero(cosine >= COSINE)):
        item = space.items[i]
        first, key = starts[used[p]], (int(doc[used[p]]), int(i))
        a = max(w.first[key[0]], first - len(item))
        b = min(w.first[key[0] + 1], first + 2 * HALF + len(item))
        near = hashed[a:b].tolist()
        # The item's words found in the window bound the common subsequence from above.
        inside = set(near)
        if 100 * sum(x in inside for x in item) < LCS_PERCENT * len(item):
            continue
        shared = common_subsequence(item, near)
        if key in out and out[key][0] >= shared:
            continue
        answer = item[-max(1, len(item) // 4) :]
        if 100 * shared >= LCS_PERCENT * len(item) and 100 * common_subsequence(answer, near) >= ANSWER_PERCENT * len(answer):
            out[key] = (shared, float(cosine[p, i]))
    return out


def _spaces(docs: DataFrame, benchmark: DataFrame) -> list[Space]:
    """Latent spaces of the items, block by block; the benchmark is a stated set of queries."""
    rows = benchmark.where("item_id is not null").select("item_id", F.coalesce("text", F.lit("")).alias("text")).orderBy("item_id", "text").collect()
    items = [(r.item_id, r.text) for r in rows]
    blocks = [items[k : k + BLOCK] for k in range(0, len(items), BLOCK)]
    every = np.unique(np.concatenate([np.zeros(0, np.uint64), *map(item_terms, blocks)]))
    if not len(every):
        return []
    # One pass counts the terms of all blocks.
    counted = (every, *_frequencies(docs.select("text"), every))
    found = [fit(docs.select("text"), block, counted) for block in blocks]
    return [s for s in found if s is not None]


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, item_words, common_words and cosine of every leak."""
    spaces = _spaces(docs, benchmark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "item_id", "item_words", "common_words", "cosine"]
    held = docs.sparkSession.sparkContext.broadcast(spaces)  # terms of the benchmark x dimensions

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, w, hashed in _slices(batches):
            for space in held.value:
                hits = leaks(w, hashed, space)
                columns = [
                    part.column("doc_id").take(pa.array([d for d, _ in hits], pa.int64())), pa.array([space.ids[i] for _, i in hits], pa.int64()),
                    pa.array([len(space.items[i]) for _, i in hits], pa.int64()), pa.array([n for n, _ in hits.values()], pa.int64()),
                    pa.array([c for _, c in hits.values()], pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, item_id long, item_words long, common_words long, cosine double")


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any leak, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(_spaces(docs, benchmark))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, w, hashed in _slices(batches):
            keep = np.ones(part.num_rows, bool)
            for space in held.value:
                for text, _ in leaks(w, hashed, space):
                    keep[text] = False
            yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
