"""N-gram Jaccard join: exact links between documents whose shingle sets overlap enough.

A document's set holds the hashes of its distinct ``width``-word shingles (A-Z taken as a-z);
with fewer words, the whole sequence is the one shingle. Documents link when
100 * intersection >= percent * union. The steps:

1. Equal sets become one class, represented by its smallest id; only representatives go on.
2. Two sets that link share a shingle among the first ``n - ceil(percent * n / 100) + 1`` of any
   common order. The order puts frequent shingles, such as those of a template, last (a table
   of at most ``FREQUENT`` rows; it only steers cost, every order gives the same links).
3. Tiles are (shingle, size band): representatives that share a prefix shingle and whose sizes
   are in one band or neighbouring ones. The members with the least hashes of their ids are the
   hubs of their tiles, and every member meets the least of its hubs: one pair per member.
4. Candidates are tested with hashed bitmaps of two bits or more for each shingle: bits that one has and the other lacks
   bound the overlap from above. Survivors meet in an exact sorted-array intersection.
5. Components of the links so far. Tiles that still hold several components are cut into blocks
   of bounded size, where the members outside the tile's largest component are tested against
   all others, by brief bitmaps and then exactly: only such pairs can still connect anything, so
   no link between components is lost and copies are never paired again. A block keeps its
   components in a union-find and yields only links that join two of them, so no block yields
   more rows than it has members, however large its groups of copies.

Null and empty texts have an empty set, no links, and are their own component. Repeated rows
share a class. Rows with a null id get their class's component (null if no row of it has an id).
Very long texts are sets like others. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabularium.llm import words as W
from tabularium.llm.components import components
from tabularium.session import stored

FREQUENT = 100_000  # shingles that may be put last; 0.8 MB in each task
COUNTERS = 1 << 20  # counters of shingles in a task; 16 MB
TILE_ROWS = 512  # members of a tile, about, in one side of a block
BRIEF = 1024  # bits of the bitmaps that blocks test
BITS_PER_SHINGLE = 2  # at least, in a bitmap of a power of two bits


def shingle_sets(w: W.Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of each distinct shingle, ordered by text and hash."""
    hashed = W.hashes(w, fold=True)
    at, found = W.windows(w, hashed, width)
    doc = w.doc[at]
    counts = np.diff(w.first)
    for n in range(1, width):  # whole sequences of n words
        short = np.flatnonzero(counts == n)
        if len(short):
            total = np.full(len(short), n, np.uint64)
            for k in range(n):
                total = W.mix(total + hashed[w.first[short] + k])
            doc, found = np.concatenate([doc, short]), np.concatenate([found, total])
    order = np.lexsort((found, doc))
    doc, found = doc[order], found[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (found[1:] != found[:-1])
    return doc[new], found[new]


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices with the bounds of their sets and all hashes."""
    for part in W.slices(batch):
        doc, found = shingle_sets(W.split(part.column("text")), width)
        yield part, np.searchsorted(doc, np.arange(part.num_rows + 1)), found


def heavy(held: np.ndarray, counts: np.ndarray, found: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray]:
    """The counters ``held`` with the hashes ``found`` added; beyond ``most`` all lose the next largest count."""
    weight = np.concatenate([counts, np.ones(sum(map(len, found)), np.int64)])
    held, at = np.unique(np.concatenate([held, *found]), return_inverse=True)
    counts = np.bincount(at, weights=weight, minlength=len(held)).astype(np.int64)
    if len(held) > most:
        counts = counts - np.partition(counts, len(counts) - most - 1)[len(counts) - most - 1]
    return held[counts > 0], counts[counts > 0]


def frequent_shingles(docs: DataFrame, width: int, most: int) -> np.ndarray:
    """Sorted hashes of at most ``most`` shingles, those with the most repeats within tasks.

    Each task counts all its documents in at most ``COUNTERS`` counters, so neither the size of
    batches nor the number of partitions decides what is found: a count falls short by at most
    1 per task plus the occurrences there divided by ``COUNTERS``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts, fresh = np.zeros(0, np.uint64), np.zeros(0, np.int64), []
        for batch in batches:
            for _, _, found in _sets(batch, width):
                fresh.append(found)
                if sum(map(len, fresh)) >= COUNTERS:
                    held, counts = heavy(held, counts, fresh, COUNTERS)
                    fresh = []
        held, counts = heavy(held, counts, fresh, COUNTERS)
        held, counts = held[counts > 1], counts[counts > 1]
        best = np.argsort(-counts, kind="stable")[:most]
        for i in range(0, len(best), 10_000):
            part = best[i : i + 10_000]
            yield pa.record_batch({"shingle": pa.array(held[part].view(np.int64)), "n": pa.array(counts[part])})

    rows = docs.select("text").mapInArrow(run, "shingle long, n long")
    top = rows.groupBy("shingle").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(most).select("shingle")
    return np.sort(np.array([r.shingle for r in top.collect()], np.int64).view(np.uint64))


def _prefixes(docs: DataFrame, width: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """id, n, signatures, prefix, bitmap and brief bitmap of every document."""
    held = docs.sparkSession.sparkContext.broadcast(frequent)  # at most FREQUENT hashes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = held.value
        for batch in batches:
            for part, bounds, found in _sets(batch, width):
                n = np.diff(bounds)
                weight = W.mix(found + np.uint64(1))
                total = np.concatenate([[np.uint64(0)], np.cumsum(weight)])
                other = np.concatenate([[np.uint64(0)], np.cumsum(W.mix(weight ^ np.uint64(0x5851F42D4C957F2D)))])
                where = np.minimum(np.searchsorted(last, found), max(len(last) - 1, 0))
                late = last[where] == found if len(last) else np.zeros(len(found), bool)
                doc = np.repeat(np.arange(len(n)), n)
                order = np.lexsort((weight, late, doc))
                keep = n - -(-percent * n // 100) + (n > 0)
                rank = np.arange(len(found)) - bounds[:-1][doc]
                prefix = found[order][rank < keep[doc]]
                size = 1 << np.ceil(np.log2(np.maximum(n * BITS_PER_SHINGLE / 64, 4))).astype(np.int64)
                begin = np.concatenate([[0], np.cumsum(size)])
                bits = np.zeros(begin[-1], np.uint64)
                spot = weight & (size[doc] * 64 - 1).astype(np.uint64)
                np.bitwise_or.at(bits, begin[:-1][doc] + (spot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (spot & np.uint64(63)))
                brief = np.zeros((len(n), BRIEF // 64), np.uint64)
                spot = weight & np.uint64(BRIEF - 1)
                np.bitwise_or.at(brief, (doc, (spot >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (spot & np.uint64(63)))
                edges = np.concatenate([[0], np.cumsum(keep)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), pa.array(n.astype(np.int64)),
                        pa.array((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64)),
                        pa.array((other[bounds[1:]] - other[bounds[:-1]]).view(np.int64)),
                        pa.ListArray.from_arrays(edges, pa.array(prefix.view(np.int64))),
                        pa.array([bits[i:j].tobytes() for i, j in zip(begin, begin[1:])], pa.binary()),
                        pa.array([row.tobytes() for row in brief], pa.binary()),
                    ],
                    ["id", "n", "sig", "sig2", "prefix", "bitmap", "brief"],
                )

    return docs.mapInArrow(run, "id long, n long, sig long, sig2 long, prefix array<long>, bitmap binary, brief binary")


def overlap_bound(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> int:
    """Upper bound of the intersection of sets with bitmaps ``a`` and ``b``; the longer is folded."""
    a, b = (np.bitwise_or.reduce(x.reshape(-1, min(len(a), len(b)))) for x in (a, b))
    only_a, only_b = int(np.bitwise_count(a & ~b).sum()), int(np.bitwise_count(b & ~a).sum())
    return min(n_a - only_a, n_b - only_b)


def _block_pairs(rows: dict[str, np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs of one block that may link two components, by size and brief bitmap."""
    n, side, bits = rows["n"], rows["side"], rows["brief"]
    i, j = np.triu_indices(len(n), 1)
    meet = (rows["component"][i] != rows["component"][j]) & (rows["own"][i] | rows["own"][j]) & (rows["outside"][i] | rows["outside"][j])
    meet &= ((side[i] == 0) | (side[i] != side[j])) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
    i, j = i[meet], j[meet]
    only_i, only_j = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
    for word in bits.T:
        x, y = word[i], word[j]
        only_i += np.bitwise_count(x & ~y)
        only_j += np.bitwise_count(y & ~x)
    most = np.minimum(n[i] - only_i, n[j] - only_j)
    good = 100 * most >= percent * (n[i] + n[j] - most)
    return i[good], j[good]


def _links(x: bytes, y: bytes, percent: int) -> bool:
    """Whether two sets, sorted hashes as bytes, link."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    at = np.searchsorted(a, b)
    both = int((a[np.minimum(at, len(a) - 1)] == b).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _block_links(rows: dict[str, np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the links of one block that join two of its components, fewer than its rows."""
    i, j = _block_pairs(rows, percent)
    comp = np.unique(rows["component"], return_inverse=True)[1].tolist()
    root = list(range(max(comp, default=-1) + 1))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    sets, good = rows["shingles"], []
    for k, (x, y) in enumerate(zip(i.tolist(), j.tolist())):
        p, q = find(comp[x]), find(comp[y])
        if p != q and _links(sets[x], sets[y], percent):
            root[max(p, q)] = min(p, q)
            good.append(k)
    return i[good], j[good]


def _paired(members: DataFrame, percent: int, exact: bool = True) -> DataFrame:
    """(a, b) of members of a tile that may link, found block by block.

    A tile's members are dealt into groups of about ``TILE_ROWS`` and every two groups meet in
    one block, so a tile of any size is spread over many tasks and none holds more than a block.
    With ``exact``, only links that join two components of a block become rows; otherwise the
    pairs that pass the brief bitmaps do (``shingles`` may then be null).
    """
    group = F.pmod(F.xxhash64("a"), F.col("groups"))
    dealt = members.withColumn("group", group).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    low, high = F.least("group", "other"), F.greatest("group", "other")
    side = F.when(low == high, 0).when(F.col("group") == low, 1).otherwise(2)
    block = F.xxhash64("shingle", "tile", low, high)
    names = ["block", "side", "a", "n", "component", "own", "outside", "brief", "shingles"]
    dealt = dealt.withColumn("block", block).withColumn("side", side).select(*names)

    def test(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        edges = np.flatnonzero(np.diff(rows["block"])) + 1
        for start, stop in zip([0, *edges], [*edges, len(rows["block"])]):
            if stop - start > 1:
                i, j = (_block_links if exact else _block_pairs)({c: v[start:stop] for c, v in rows.items()}, percent)
                pairs.append((rows["a"][start + i], rows["a"][start + j]))
        x, y = (np.concatenate(side) for side in zip(*pairs))
        return pa.record_batch({"a": pa.array(np.minimum(x, y)), "b": pa.array(np.maximum(x, y))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names[:-2]}
            rows["brief"] = np.frombuffer(b"".join(batch.column("brief").to_pylist()), np.uint64).reshape(batch.num_rows, -1)
            rows["shingles"] = np.array(batch.column("shingles").to_pylist() + [None], object)[:-1]
            if held is not None:
                rows = {c: np.concatenate([held[c], v]) for c, v in rows.items()}
            last = int(np.searchsorted(rows["block"], rows["block"][-1]))  # its block may go on
            held = {c: v[last:] for c, v in rows.items()}
            yield test({c: v[:last] for c, v in rows.items()})
        if held is not None:
            yield test(held)

    found = dealt.repartition("block").sortWithinPartitions("block").mapInArrow(run, "a long, b long")
    return found.distinct()


def _with(pairs: DataFrame, facts: DataFrame, names: list[str]) -> DataFrame:
    """Pairs (a, b) with the named facts of both ends."""
    for end in ("a", "b"):
        pairs = pairs.join(facts.select(F.col("id").alias(end), *(F.col(c).alias(f"{c}_{end}") for c in names)), end)
    return pairs


def _bounded(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The candidate pairs whose bitmaps leave enough room for a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y, n_a, n_b in zip(*(batch.column(c).to_pylist() for c in ("bitmap_a", "bitmap_b", "n_a", "n_b"))):
                most = overlap_bound(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), n_a, n_b)
                good.append(100 * most >= percent * (n_a + n_b - most))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return _with(pairs, reps, ["n", "bitmap"]).mapInArrow(run, "a long, b long")


def _arrays(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, shingles) of the documents of ``ids`` (id): sorted hashes as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, bounds, found in _sets(batch, width):
                raw = [found[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:])]
                yield pa.record_batch({"id": part.column("id"), "shingles": pa.array(raw, pa.binary())})

    found = docs.join(ids, "id", "left_semi").mapInArrow(run, "id long, shingles binary")
    return found.dropDuplicates(["id"])


def _exact(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs that link, by intersecting their sorted arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = zip(batch.column("shingles_a").to_pylist(), batch.column("shingles_b").to_pylist())
            good = [_links(x, y, percent) for x, y in ends]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    ends = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    return _with(pairs, stored(_arrays(docs, ends, width), "arrays"), ["shingles"]).mapInArrow(run, "a long, b long")


def brief_of(facts: DataFrame, chosen: DataFrame) -> DataFrame:
    """(a, brief) of every representative."""
    return facts.select(F.col("id").alias("a"), "brief").join(chosen.withColumnRenamed("id", "a"), "a", "left_semi").dropDuplicates(["a"])


def _bands(n, percent: int):
    """Band of a size: sizes that may link are in one band or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / float(np.log(100 / percent))).cast("int")


def link_documents(docs: DataFrame, width: int = 4, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, component_id, class_id and n_copies of every row of ``docs``."""
    kind = docs.schema[key].dataType.simpleString()
    docs = docs.select(docs[key].cast("long").alias("id"), docs[text].alias("text"))
    frequent = frequent_shingles(docs, width, FREQUENT)
    facts = stored(_prefixes(docs, width, percent, frequent), "prefixes")
    same = ["n", "sig", "sig2"]
    reps = facts.where("n > 0").groupBy(*same).agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    reps = stored(reps, "classes")
    chosen = reps.where("id is not null").select("id")

    # One shuffle of the prefixes; shingles of a single representative end here.
    tiles = facts.join(chosen, "id", "left_semi").select(F.explode("prefix").alias("shingle"), F.col("id").alias("a"), F.col("n").cast("int").alias("n"))
    crowded = tiles.withColumn("size", F.count("*").over(Window.partitionBy("shingle"))).where("size > 1")
    crowded = stored(crowded.select("shingle", "a", "n", _bands(F.col("n"), percent).alias("band")), "tiles")
    # The least member of a tile's own band and of the band below stand for all of them.
    least = F.min(F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("b"), F.col("n").alias("m"))).alias("least")
    hubs = crowded.groupBy("shingle", "band").agg(least).select("shingle", F.explode(F.array("band", F.col("band") + 1)).alias("band"), "least.*")
    fits = (100 * F.least("n", "m") >= percent * F.greatest("n", "m")) & (F.col("a") != F.col("b"))
    # Every member first meets one of its hubs only, the least of all, which links most copies.
    first = crowded.join(hubs, ["shingle", "band"]).where(fits).groupBy("a").agg(F.min(F.struct("h", "b")).alias("least"))
    first = stored(first.select(F.least("a", "least.b").alias("a"), F.greatest("a", "least.b").alias("b")).distinct(), "candidates")
    bitmaps = facts.select("id", "n", "bitmap").join(chosen, "id", "left_semi").dropDuplicates(["id"])
    links = stored(_exact(stored(_bounded(first, bitmaps, percent), "bounded"), docs, width, percent), "links")
    found = components(links)

    # What may still connect two components: members outside the largest component of a tile.
    placed = crowded.join(found.withColumnRenamed("id", "a"), "a", "left").withColumn("component", F.coalesce("component", "a"))
    placed = placed.select("shingle", F.explode(F.array("band", F.col("band") + 1)).alias("tile"), "a", "n", "component", "band")
    placed = placed.select("shingle", "tile", "a", "n", "component", (F.col("tile") == F.col("band")).alias("own"))
    sizes = placed.groupBy("shingle", "tile", "component").agg(F.count("*").alias("size"))
    main = sizes.groupBy("shingle", "tile").agg(
        F.max_by("component", F.struct("size", "component")).alias("main"), F.count("*").alias("parts"),
        F.ceil(F.sum("size") / TILE_ROWS).alias("groups"),
    )
    placed = placed.join(main.where("parts > 1").drop("parts"), ["shingle", "tile"]).withColumn("outside", F.col("component") != F.col("main"))
    placed = placed.join(brief_of(facts, chosen), "a")
    # Tiles of one group: pairs that pass the brief bitmaps, then bitmaps and exact intersection.
    # Larger tiles, where pairs grow with the square of their size, test exactly in the block.
    small = placed.where("groups = 1").withColumn("shingles", F.lit(None).cast("binary"))
    large = placed.where("groups > 1")
    sets = _arrays(docs, large.select(F.col("a").alias("id")).distinct(), width).withColumnRenamed("id", "a")
    # Two members of one band share two tiles and meet in the lower, where they are at home.
    rest = _paired(small, percent, exact=False)
    more = _exact(stored(_bounded(rest, bitmaps, percent), "bounded"), docs, width, percent)
    more = more.union(_paired(large.join(stored(sets, "arrays"), "a"), percent))
    found = components(links.union(more))

    classes = reps.select(*same, F.col("id").alias("class_id"), "copies").join(found.withColumnRenamed("id", "class_id"), "class_id", "left")
    out = facts.select("id", *same).join(classes, same, "left")
    return out.select(
        F.col("id").cast(kind).alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.coalesce("component", "class_id")).cast(kind).alias("component_id"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("class_id")).cast(kind).alias("class_id"),
        F.coalesce("copies", F.lit(1)).alias("n_copies"),
    )
