"""Collocation mining: candidate phrases counted by double-array tries that every task walks.

Words and phrases of a language are known by 64-bit keys, a phrase's made of those of the phrases
without its last and without its first word; equal keys count as equal phrases. First, level by
level, what may be frequent is found: a phrase of k words can only be frequent if both its phrases
of k - 1 words are, so each level sums the keys of just those windows and hands a bit filter of the
keys that reach the limit to the next. The filters have a fixed greatest size and no false
negatives. Joins of the levels then tell the words of every candidate, without another pass.

The candidates are dealt by key into shards of about ``SHARD`` phrases, and a task per shard builds
a double-array trie of their words. Shard after shard is broadcast (its size is bounded by the
shard); tasks stream all documents through it: all positions of a slice take their next word at
once, a level at a time, accepting states are counted by ``bincount``, and the vectors of all tasks
are summed in blocks. Only phrases whose counts of the trie reach the limit stay. The spelling
of words is fetched last, for the phrases that are reported or tie with one.

Null texts are empty, a null language is ``und``. Repeated rows count as often as they occur,
ids play no part, columns other than text and language are ignored. Long texts are taken whole.
An empty table, or one without a frequent phrase, gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabularium.llm import words as W
from tabularium.session import new_path, stored

LONGEST = 5  # words of a phrase
SLICE_BYTES = 1 << 19
KEPT = 1 << 20  # keys that a task sums before it hands them on
FILTER_BITS = 27  # a filter has at most 2 ** 27 bits; a fuller one costs time, never phrases
SHARD = 1 << 18  # candidates of a trie
VECTOR = 1 << 12  # counts that are summed as one value
WINDOW = 1 << 16  # slots behind the last one used that are searched for room for a state's children
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", 10, 11, 12, 13]] = True
_GAP = _BREAK.copy()
_GAP[[9, 32]] = True


class Pieces(NamedTuple):
    """The words of the texts of a slice."""

    data: np.ndarray  # bytes, A-Z lower-cased
    starts: np.ndarray
    ends: np.ndarray
    keys: np.ndarray  # of the word in its language
    left: np.ndarray  # words from here to the end of the piece
    row: np.ndarray  # text of each word
    langs: np.ndarray  # key of each text's language


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings, one after another, and the bounds of each."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def split(batch: pa.RecordBatch) -> Pieces:
    """Words and pieces of the columns text and lang."""
    data, bounds = _bytes(batch.column("text").fill_null(""))
    names, cuts = _bytes(batch.column("lang").fill_null("und"))
    langs = W.mix(W.span_hashes(names, cuts[:-1], cuts[1:]) ^ _BASE)
    data = _LOWER[data]
    solid = ~_GAP[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = solid[:-1], solid[1:]
    before[bounds[:-1][bounds[:-1] < len(data)]] = False
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    row = np.repeat(np.arange(batch.num_rows), np.diff(np.searchsorted(starts, bounds)))
    breaks = np.cumsum(_BREAK[data])[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(row) > 0) | (np.diff(breaks) > 0)
    firsts = np.append(np.flatnonzero(new), len(starts))
    left = np.repeat(firsts[1:], np.diff(firsts)) - np.arange(len(starts))
    keys = W.mix(W.span_hashes(data, starts, ends) + langs[row])
    return Pieces(data, starts, ends, keys, left, row, langs)


def pair_keys(head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Key of the phrase whose parts without the last and without the first word have these keys."""
    return W.mix(W.mix(head) * _BASE + tail)


class Filter(NamedTuple):
    """Which keys may be in a set: a bit array of three probes."""

    bits: int
    words: np.ndarray

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for j in range(3):
            at = (keys >> np.uint64(18 * j)) & np.uint64((1 << self.bits) - 1)
            found &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found


def build_filter(keys: DataFrame) -> Filter:
    """The filter of a table of keys, built by tasks; at most 2 ** FILTER_BITS bits reach the driver."""
    bits = min(max(keys.count() * 16, 1 << 12).bit_length(), FILTER_BITS)
    probes = [F.shiftrightunsigned("key", 18 * j).bitwiseAND(F.lit((1 << bits) - 1)) for j in range(3)]
    at = keys.select(F.explode(F.array(*probes)).alias("at"))
    bit = F.expr("shiftleft(1L, cast(at & 63 as int))")
    rows = at.groupBy(F.shiftright("at", 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toPandas()
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[rows["at"].to_numpy()] = rows["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return Filter(bits, words)


def levels(p: Pieces, filters: list[Filter]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per level the keys at all positions and which of them pass, with every phrase inside, their filters."""
    keys, alive = p.keys, np.ones(len(p.keys), bool)
    for k, one in enumerate(filters, 1):
        if k > 1:
            keys, alive = step(p, keys, alive, k)
        alive[alive] = one.has(keys[alive])
        yield keys, alive


def step(p: Pieces, keys: np.ndarray, alive: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of ``k`` words at all positions where both phrases of k - 1 words are alive."""
    on = np.zeros(len(keys), bool)
    on[:-1] = alive[:-1] & alive[1:] & (p.left[:-1] >= k)
    at, longer = np.flatnonzero(on), np.zeros(len(keys), np.uint64)
    longer[at] = pair_keys(keys[at], keys[at + 1])
    return longer, on


class Sums:
    """How often keys occur, with the two keys that each is made of; sorted, merged as they come."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.columns, self.parts, self.held = [np.zeros(0, np.uint64)] * 3 + [np.zeros(0, np.int64)], [], 0

    def __len__(self) -> int:
        return len(self.columns[0])

    def add(self, keys: np.ndarray, head: np.ndarray, tail: np.ndarray) -> None:
        keys, first, n = np.unique(keys, return_index=True, return_counts=True)
        self.parts.append([keys, head[first], tail[first], n])
        self.held += len(keys)
        if self.held > max(len(self), KEPT // 4):
            self.merge()

    def merge(self) -> None:
        keys, head, tail, n = (np.concatenate(c) for c in zip(self.columns, *self.parts))
        self.parts, self.held = [], 0
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        n = np.add.reduceat(n[order], first) if len(first) else n
        self.columns = [keys[first], head[order[first]], tail[order[first]], n]

    def batch(self) -> pa.RecordBatch:
        self.merge()
        return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in self.columns[1:]], ["head", "tail", "n"])


def frequent(docs: DataFrame, filters: list[Filter], least: int) -> DataFrame:
    """(key, head, tail, n) of the next level's windows that occur ``least`` times.

    At the first level the head of a word is its language, which is also a row of its own.
    """
    held, k = docs.sparkSession.sparkContext.broadcast([tuple(f) for f in filters]), len(filters) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, known = Sums(), [Filter(*f) for f in held.value]
        for batch in batches:
            for piece in W.slices(batch, limit=SLICE_BYTES):
                p = split(piece)
                if k == 1:
                    langs = p.langs[p.row]
                    sums.add(p.keys, langs, p.keys)
                    sums.add(langs, langs, langs)
                else:
                    for shorter, alive in levels(p, known):
                        pass
                    keys, on = step(p, shorter, alive, k)
                    at = np.flatnonzero(on)
                    sums.add(keys[at], shorter[at], shorter[at + 1])
                if len(sums) > KEPT:
                    yield sums.batch()
                    sums.clear()
        yield sums.batch()

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            head, tail = (batch.column(c).to_numpy().view(np.uint64) for c in ("head", "tail"))
            keys = tail if k == 1 else pair_keys(head, tail)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *batch.columns], ["key", "head", "tail", "n"])

    found = docs.mapInArrow(run, "head long, tail long, n long").groupBy("head", "tail").agg(F.sum("n").alias("n"))
    return stored(found.where(F.col("n") >= least).mapInArrow(name, "key long, head long, tail long, n long"), f"frequent-{k}")


def candidates(tables: list[DataFrame]) -> DataFrame:
    """(key, whole, words, heads, tails) of every phrase of two words or more in the levels' tables.

    ``whole`` is the language's key; heads and tails are the keys of both parts of every cut.
    """
    none = F.array().cast("array<long>")
    shorter = tables[0].select("key", F.col("head").alias("whole"), F.array("key").alias("words"), none.alias("heads"), none.alias("tails"))
    out = shorter.limit(0)
    for level in tables[1:]:
        first = shorter.select(F.col("key").alias("head"), "whole", F.col("words").alias("before"), "heads")
        last = shorter.select(F.col("key").alias("tail"), F.col("words").alias("after"), "tails")
        own = level.join(first, "head").join(last, "tail")
        shorter = stored(own.select(
            "key", "whole", F.concat("before", F.slice("after", -1, 1)).alias("words"),
            F.concat("heads", F.array("head")).alias("heads"), F.concat(F.array("tail"), "tails").alias("tails"),
        ), "candidates")
        out = out.unionByName(shorter)
    return out


class Trie(NamedTuple):
    """A double array over the words of a shard: a state's child by word w is base[state] + w."""

    words: np.ndarray  # sorted keys
    labels: np.ndarray  # the number, from 1, of each
    base: np.ndarray  # 0 where a state has no child
    check: np.ndarray  # parent state of each slot, -1 for none; the root is slot 0
    accepts: np.ndarray  # number of the phrase that ends in a state, or -1
    phrases: np.ndarray  # key of each phrase

    def walk(self, p: Pieces) -> Iterator[np.ndarray]:
        """Per level the states of all positions that are still in the trie."""
        word = np.minimum(np.searchsorted(self.words, p.keys), len(self.words) - 1)
        word = np.where(self.words[word] == p.keys, self.labels[word], 0)
        at = np.flatnonzero(word)
        state, depth = np.zeros(len(at), np.int64), 0
        while len(at):
            step = self.base[state] + word[at + depth]
            on = self.check[step] == state
            at, state = at[on], step[on]
            yield state
            depth += 1
            on = (p.left[at] > depth) & (self.base[state] > 0)
            at, state = at[on], state[on]
            on = word[at + depth] > 0
            at, state = at[on], state[on]


def build_trie(phrases: np.ndarray, words: list[np.ndarray]) -> Trie:
    """The trie of phrases, given by key and by the keys of their words."""
    sizes = np.array([len(w) for w in words])
    flat = np.concatenate(words)
    known, number, often = np.unique(flat, return_inverse=True, return_counts=True)
    label = np.empty(len(known), np.int64)  # frequent words get small labels, which keeps the rows of a state short
    label[np.argsort(-often, kind="stable")] = np.arange(1, len(known) + 1)
    labels = np.zeros((len(words), sizes.max()), np.int64)  # 0 where a phrase has ended
    labels[np.arange(sizes.max()) < sizes[:, None]] = label[number]
    node, parents, names = np.zeros(len(words), np.int64), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    ends, count = np.zeros(len(words), np.int64), 1
    for depth in range(labels.shape[1]):
        going = np.flatnonzero(sizes > depth)
        edge, inverse = np.unique(node[going] * (len(known) + 1) + labels[going, depth], return_inverse=True)
        parents.append(edge // (len(known) + 1))
        names.append(edge % (len(known) + 1))
        node[going] = count + inverse
        count += len(edge)
        ends[going] = node[going]
    parent, name = np.concatenate(parents), np.concatenate(names)  # of nodes 1, 2, ...
    order = np.lexsort((name, parent))
    parent, name, child = parent[order], name[order], order + 1
    first = np.flatnonzero(np.append(True, np.diff(parent) > 0))
    last = np.append(first[1:], len(parent))
    room = len(known) + 2  # children lie behind as many slots as there are words, so that bases stay positive
    free = np.ones(2 * room + 2 * len(parent), bool)
    free[:room] = False
    base, slot, top = np.zeros(count, np.int64), np.zeros(count, np.int64), room
    many = np.flatnonzero(last - first > 1)
    for f in many[np.argsort(-(last - first)[many], kind="stable")]:
        own = name[first[f] : last[f]]
        if top + own[-1] >= len(free):
            free = np.append(free, np.ones(len(free) + int(own[-1]), bool))
        low = max(room, top - WINDOW)
        at = low + np.flatnonzero(free[low : top + 1])  # where the first child may go; the last of these always fits
        for w in own[1:]:
            at = at[free[at + (w - own[0])]]
        place = int(at[0]) - int(own[0])
        free[place + own] = False
        top = max(top, place + int(own[-1]) + 1)
        base[parent[first[f]]], slot[child[first[f] : last[f]]] = place, place + own
    single = first[last - first == 1]
    places = np.flatnonzero(free)[: len(single)]
    if len(places) < len(single):
        places = np.append(places, len(free) + np.arange(len(single) - len(places)))
    base[parent[single]], slot[child[single]] = places - name[single], places
    size = int(slot.max()) + len(known) + 2
    bases, check, accepts = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    bases[slot] = base
    check[slot[child]] = slot[parent]
    accepts[slot[ends]] = np.arange(len(phrases))
    return Trie(known, label.astype(np.int32), bases, check, accepts, phrases)


def tries(found: DataFrame, shards: int) -> DataFrame:
    """One row per shard of the candidates: the trie as bytes."""

    def build(table: pa.Table) -> pa.Table:
        import pickle

        keys = table.column("key").to_numpy().view(np.uint64)
        words = [np.array(w, np.int64).view(np.uint64) for w in table.column("words").to_pylist()]
        blob = pickle.dumps(tuple(build_trie(keys, words)))
        return pa.table({"shard": table.column("shard").slice(0, 1), "trie": pa.array([blob], pa.binary())})

    dealt = found.select(F.pmod("key", F.lit(shards)).cast("int").alias("shard"), "key", "words")
    return stored(dealt.groupBy("shard").applyInArrow(build, "shard int, trie binary"), "tries")


def count_phrases(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(key, n) of every candidate: shard after shard, all documents walk through its trie."""
    import pickle

    spark = docs.sparkSession
    shards = -(-found.count() // SHARD)
    built, path = tries(found, max(shards, 1)), new_path(spark, "phrase-counts")
    lanes = math.isqrt(docs.rdd.getNumPartitions()) + 1
    for shard in range(shards):
        rows = built.where(F.col("shard") == shard).select("trie").collect()  # one trie of about SHARD phrases
        if not rows:
            continue
        held = spark.sparkContext.broadcast(pickle.loads(rows[0].trie))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            trie = Trie(*held.value)
            counts, parts, size = np.zeros(len(trie.base), np.int64), [], 0
            for batch in batches:
                for piece in W.slices(batch, limit=SLICE_BYTES):
                    for states in trie.walk(split(piece)):
                        parts.append(states)
                        size += len(states)
                    if size > len(counts):
                        counts += np.bincount(np.concatenate(parts), minlength=len(counts))
                        parts, size = [], 0
            if parts:
                counts += np.bincount(np.concatenate(parts), minlength=len(counts))
            own = np.zeros(-(-len(trie.phrases) // VECTOR) * VECTOR, np.int64)
            ends = np.flatnonzero(trie.accepts >= 0)
            own[trie.accepts[ends]] = counts[ends]
            vectors = own.reshape(-1, VECTOR)
            met = np.flatnonzero(vectors.any(axis=1)).astype(np.int32)
            lane = np.full(len(met), TaskContext.get().partitionId() % lanes, np.int32)
            columns = [pa.array(met), pa.array(lane), pa.array([v.tobytes() for v in vectors[met]], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "lane", "vector"])

        def add(table: pa.Table) -> pa.Table:
            total = np.zeros(VECTOR, np.int64)
            for v in table.column("vector").to_pylist():
                total += np.frombuffer(v, np.int64)
            return table.slice(0, 1).set_column(2, "vector", pa.array([total.tobytes()], pa.binary()))

        def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            phrases = held.value[-1]
            for batch in batches:
                for block, v in zip(batch.column("block").to_pylist(), batch.column("vector").to_pylist()):
                    keys = phrases[block * VECTOR : (block + 1) * VECTOR]
                    columns = [pa.array(keys.view(np.int64)), pa.array(np.frombuffer(v, np.int64)[: len(keys)])]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "n"])

        kind = "block int, lane int, vector binary"
        sums = docs.mapInArrow(run, kind).groupBy("block", "lane").applyInArrow(add, kind).groupBy("block").applyInArrow(add, kind)
        sums.mapInArrow(name, "key long, n long").write.parquet(f"{path}/shard-{shard}")
    if not shards:
        return spark.createDataFrame([], "key long, n long")
    return spark.read.schema("key long, n long").option("recursiveFileLookup", "true").parquet(path)


def spellings(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, word) of the wanted keys of words and languages, as the documents spell them."""
    held = docs.sparkSession.sparkContext.broadcast(tuple(build_filter(wanted)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = Filter(*held.value), np.zeros(0, np.uint64)
        for batch in batches:
            for piece in W.slices(batch, limit=SLICE_BYTES):
                p = split(piece)
                keys, first = np.unique(p.keys, return_index=True)
                new = known.has(keys) & ~np.isin(keys, seen)
                langs, row = np.unique(p.langs, return_index=True)
                old = np.isin(langs, seen)
                langs, row = langs[~old], row[~old]
                words = [p.data[p.starts[i] : p.ends[i]].tobytes() for i in first[new]]
                names = piece.column("lang").fill_null("und").take(pa.array(row)).cast(pa.string()).to_pylist()
                keys = np.concatenate([keys[new], langs])
                seen = np.union1d(seen, keys) if len(seen) < KEPT else keys
                spelt = pa.array([*words, *[n.encode() for n in names]], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), spelt], ["key", "word"])

    return stored(docs.mapInArrow(run, "key long, word string").groupBy("key").agg(F.min("word").alias("word")), "spellings")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of every language by the score of their weakest cut.

    Columns lang, rank, phrase, a (occurrences), l and r (of the two parts of that cut), n (words
    of the language), score. Phrases that a longer candidate always contains are left out.
    """
    texts = docs.select("text", F.col("lang").cast("string").alias("lang"))
    tables, filters = [frequent(texts, [], least)], []
    while len(tables) < LONGEST and not tables[-1].isEmpty():
        filters.append(build_filter(tables[-1].select("key")))
        tables.append(frequent(texts, filters, least))
    found = candidates(tables)
    phrases = count_phrases(texts, found).where(F.col("n") >= least)
    known = stored(tables[0].select("key", "n").unionByName(phrases), "known")
    best = stored(scored(found, known, phrases, top), "best")
    parts = best.select("key", "whole", F.posexplode("words").alias("at", "part"))
    wanted = parts.select(F.col("part").alias("key")).union(parts.select("whole")).distinct()
    spelt = spellings(texts, stored(wanted, "wanted"))
    words = parts.join(spelt.withColumnRenamed("key", "part"), "part").groupBy("key").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ").alias("phrase")
    )
    rows = best.join(words, "key").join(spelt.select(F.col("key").alias("whole"), F.col("word").alias("lang")), "whole")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def scored(found: DataFrame, known: DataFrame, phrases: DataFrame, top: int) -> DataFrame:
    """The phrases among the first ``top`` of their language by score and count, and all that tie with the last.

    ``known`` has the counts of words, phrases and languages.
    """
    own = found.join(phrases.withColumnRenamed("n", "a"), "key")
    cut = own.select("key", "whole", "a", F.posexplode(F.arrays_zip("heads", "tails")).alias("k", "c"))
    cut = cut.select("key", "whole", "a", "k", F.col("c.heads").alias("head"), F.col("c.tails").alias("tail"))
    named = lambda key, n: known.select(F.col("key").alias(key), F.col("n").alias(n))
    cut = cut.join(named("head", "l"), "head").join(named("tail", "r"), "tail").join(named("whole", "n"), "whole")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cut = cut.withColumn("top", (F.lit(1000) * F.col("a")).cast("decimal(19,0)") * wide("n")).withColumn("under", wide("l") * wide("r"))
    weakest = cut.groupBy("key").agg(F.min(F.struct(F.expr("top div under").alias("score"), "k", "l", "r", "n")).alias("m"))
    last = lambda c: F.element_at(c, -1)
    inside = own.where(F.size("heads") > 1).select(F.explode(F.array(last("heads"), F.col("tails")[0])).alias("key"), "a")
    inside = inside.groupBy("key").agg(F.max("a").alias("longer"))
    kept = own.join(inside, "key", "left").where("longer IS NULL OR longer < a").join(weakest, "key")
    order = Window.partitionBy("whole").orderBy(F.desc("m.score"), F.desc("a"))
    kept = kept.withColumn("place", F.rank().over(order)).where(F.col("place") <= top)
    return kept.select("key", "whole", "words", "a", "m.l", "m.r", "m.n", "m.score")
