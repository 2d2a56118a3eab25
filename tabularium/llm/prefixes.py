"""The trie of conversation prefixes, by digests of blocks of turns.

A turn is known by 120 bits of SHA-256 over role and text, a prefix by the exclusive or of 128-bit
hashes of its turns and their places, so that prefixes combine in any order and over any number of
tasks. Conversations are cut into blocks of ``BLOCK`` turns. Those that share all blocks before are
one group, and where the whole group goes on with one same block, the block's turns are nodes of
that group: nothing is looked at turn by turn. Only blocks in which siblings diverge, or one
conversation ends and another does not, are taken apart and grouped by turn.

Sums over subtrees need no walk: every node's share is booked on its smallest member, sums run
backwards along each conversation, and a node adds up those of its members. Runs along a
conversation are made in spans, so one very long conversation is spread over tasks, as is the
order of its turns (a range sort whose partitions are numbered). The digests of members stream
through a task in bounded pieces.

Turns are ordered by number, null first, equal ones by their digest. Null roles and texts are
empty. Rows without a conversation id are no conversation and are left out. Repeated rows are
turns like others. An empty table has no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularium.session import stored

BLOCK = 8  # turns
SPAN = 1024  # blocks of a conversation that one window runs over
CHUNK_BITS = 16  # a piece of member ids covers 2 ** 16 of them
REPLACED = 6  # a conversation takes fewer turns than this from the first of its hundred
HUNDRED = 100


def running(df: DataFrame, key: str, order: str, values: list[str], how: Callable, backwards: bool = False) -> DataFrame:
    """Adds per value what all earlier rows (later ones if ``backwards``) of the key come to, 0 for none.

    Rows are numbered from 0 by ``order``; windows see ``SPAN`` of them, then one row per span.
    """
    aim = F.desc if backwards else F.asc
    df = df.withColumn("_span", F.floor(F.col(order) / SPAN))
    inside = Window.partitionBy(key, "_span").orderBy(aim(order)).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(key).orderBy(aim("_span")).rowsBetween(Window.unboundedPreceding, -1)
    whole = df.groupBy(key, "_span").agg(*[how(v).alias(v) for v in values])
    whole = whole.select(key, "_span", *[F.coalesce(how(v).over(across), F.lit(0)).alias(f"_{v}") for v in values])
    df = df.withColumns({f"run_{v}": F.coalesce(how(v).over(inside), F.lit(0)) for v in values}).join(whole, [key, "_span"])
    both = {f"run_{v}": how_two(how, F.col(f"run_{v}"), F.col(f"_{v}")) for v in values}
    return df.withColumns(both).drop("_span", *[f"_{v}" for v in values])


def how_two(how: Callable, a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b) if how is F.bit_xor else a + b


def rebuild(chat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, d, x1, x2, chars, size) of the rebuilt conversations, and (conv, size) of each.

    ``d`` counts from 1; x1 and x2 hash the turn at its place.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    number = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    turns = chat.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", number(1).alias("a"), number(16).alias("b"),
        F.char_length(text).cast("long").alias("chars"),
    )
    order = ["conv", "turn", "a", "b"]
    ranged = turns.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id())
    ranged = stored(ranged.select("conv", "a", "b", "chars", "id", F.shiftright("id", 33).alias("part")), "turns")
    heads = ranged.groupBy("conv", "part").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    each = heads.groupBy("conv").agg(F.sum("n").alias("n"))
    each = each.withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % REPLACED)
    each = each.withColumn("base", F.col("conv") - F.col("conv") % HUNDRED)
    bases = each.where(F.col("conv") % HUNDRED == 0).select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    each = each.join(bases, "base", "left").withColumn("m", F.least("h", F.coalesce("base_n", F.lit(0))))
    each = each.withColumn("size", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    each = stored(each.select("conv", "base", "h", "m", "size"), "rebuilt")
    placed = ranged.join(heads.drop("n").join(each, "conv"), ["conv", "part"])
    placed = placed.withColumn("pos", F.col("id") - F.col("first") + F.col("before") + 1)
    own = placed.where("pos > h").select("conv", (F.col("pos") - F.col("h") + F.col("m")).alias("d"), "a", "b", "chars", "size")
    lent = placed.where((F.col("conv") % HUNDRED == 0) & (F.col("pos") < REPLACED))
    lent = lent.select(F.col("conv").alias("base"), F.col("pos").alias("d"), "a", "b", "chars")
    lent = lent.join(each, "base").where("d <= h").select("conv", "d", "a", "b", "chars", "size")
    hashed = own.unionByName(lent).select(
        "conv", "d", F.xxhash64("d", "a", "b").alias("x1"), F.xxhash64("b", "d", "a").alias("x2"), "chars", "size"
    )
    return hashed, each.select("conv", "size")


def cut_blocks(turns: DataFrame) -> DataFrame:
    """(conv, blk, size, e1, e2, items): the blocks, what came before each, and its turns.

    An item has the depth, the prefix up to the turn (p1, p2) and before it (q1, q2), and the
    characters of this turn and of the rest of the block.
    """
    blocks = turns.groupBy("conv", F.floor((F.col("d") - 1) / BLOCK).alias("blk")).agg(
        F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.max("size").alias("size"),
        F.array_sort(F.collect_list(F.struct("d", "x1", "x2", "chars"))).alias("turns"),
    )
    blocks = running(blocks, "conv", "blk", ["x1", "x2"], F.bit_xor)

    def prefix(name: str, upto: Column) -> Column:
        return F.aggregate(F.slice("turns", 1, upto), F.col(f"run_{name}"), lambda s, t: s.bitwiseXOR(t[name]))

    rest = lambda i: F.aggregate(F.slice("turns", i + 1, F.size("turns")), F.lit(0).cast("long"), lambda s, t: s + t["chars"])
    items = F.transform("turns", lambda t, i: F.struct(
        t["d"].alias("d"), prefix("x1", i + 1).alias("p1"), prefix("x2", i + 1).alias("p2"), prefix("x1", i).alias("q1"),
        prefix("x2", i).alias("q2"), t["chars"].alias("chars"), rest(i).alias("rest"),
    ))
    cut = blocks.select("conv", "blk", "size", F.col("run_x1").alias("e1"), F.col("run_x2").alias("e2"), items.alias("items"))
    return stored(cut, "blocks")


def group_blocks(blocks: DataFrame) -> DataFrame:
    """Adds to each block what its group is: members n, smallest rep, how many end, and whether all are alike."""
    last = F.element_at("items", -1)
    blocks = blocks.select("*", last["p1"].alias("z1"), last["p2"].alias("z2"), last["d"].alias("zd"))
    alike = F.lit(True)
    for c in ("z1", "z2", "zd"):
        alike = alike & (F.min(c) == F.max(c))
    groups = blocks.groupBy("e1", "e2", "blk").agg(
        F.count("*").alias("n"), F.min("conv").alias("rep"), F.count_if(F.col("zd") == F.col("size")).alias("n_end"),
        alike.alias("alike"),
    )
    return stored(blocks.join(groups, ["e1", "e2", "blk"]), "grouped")


NODE = ["d", "p1", "p2", "q1", "q2", "chars", "n", "rep", "n_end"]


def nodes_of(grouped: DataFrame, diverged: DataFrame) -> DataFrame:
    """The nodes below the root; those of blocks all alike know their block and its own sums."""
    same = grouped.where("alike AND conv = rep").select("e1", "e2", "blk", "n", "rep", "n_end", "zd", F.explode("items").alias("t"))
    leaf = (F.col("n_end") == F.col("n")).cast("long")
    same = same.select(
        "t.d", "t.p1", "t.p2", "t.q1", "t.q2", "t.chars", "n", "rep", F.when(F.col("t.d") == F.col("zd"), F.col("n_end")).otherwise(0).alias("n_end"),
        "e1", "e2", "blk", ((F.col("n") - 1) * F.col("t.rest")).alias("own_v"), leaf.alias("own_u"),
    )
    single = diverged.groupBy("d", "p1", "p2", "q1", "q2", "chars").agg(
        F.count("*").alias("n"), F.min("conv").alias("rep"), F.count_if(F.col("d") == F.col("size")).alias("n_end")
    )
    empty = [F.lit(None).cast("long").alias(c) for c in ("e1", "e2", "blk", "own_v", "own_u")]
    nodes = same.select(*NODE, "e1", "e2", "blk", "own_v", "own_u").unionByName(single.select(*NODE, *empty))
    share = {"v": (F.col("n") - 1) * F.col("chars"), "u": (F.col("n") == F.col("n_end")).cast("long")}
    return stored(nodes.withColumns(share), "nodes")


def subtree_sums(nodes: DataFrame, grouped: DataFrame, diverged: DataFrame) -> DataFrame:
    """(d, p1, p2, saved, leaves) of every node: the shares v and u of its subtree."""
    booked = nodes.groupBy(F.col("rep").alias("conv"), F.floor((F.col("d") - 1) / BLOCK).alias("blk")).agg(
        F.sum("v").alias("v"), F.sum("u").alias("u")
    )
    blocks = grouped.select("conv", "blk", "e1", "e2", "alike").join(booked, ["conv", "blk"], "left").na.fill(0, ["v", "u"])
    later = stored(running(blocks, "conv", "blk", ["v", "u"], F.sum, backwards=True), "later")
    whole = later.where("alike").groupBy("e1", "e2", "blk").agg(F.sum("run_v").alias("run_v"), F.sum("run_u").alias("run_u"))
    same = nodes.where("own_v IS NOT NULL").join(whole, ["e1", "e2", "blk"])
    same = same.select("d", "p1", "p2", (F.col("own_v") + F.col("run_v")).alias("saved"), (F.col("own_u") + F.col("run_u")).alias("leaves"))
    own = nodes.where("own_v IS NULL").select(F.col("rep").alias("conv"), "d", "v", "u")
    turns = diverged.join(own, ["conv", "d"], "left").na.fill(0, ["v", "u"])
    rest = Window.partitionBy("conv", "blk").orderBy(F.desc("d"))
    turns = turns.withColumns({"v": F.sum("v").over(rest), "u": F.sum("u").over(rest)})
    turns = turns.join(later.where("NOT alike").select("conv", "blk", "run_v", "run_u"), ["conv", "blk"])
    single = turns.groupBy("d", "p1", "p2").agg(
        F.sum(F.col("v") + F.col("run_v")).alias("saved"), F.sum(F.col("u") + F.col("run_u")).alias("leaves")
    )
    return same.unionByName(single)


def end_digests(ends: DataFrame) -> DataFrame:
    """(d, p1, p2, ends_sha256) of the ids ``conv`` that end in each node, in ascending order.

    Ids are joined in pieces of up to 2 ** CHUNK_BITS first; a node's pieces then pass through its digest.
    """
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    pieces = ends.groupBy("d", "p1", "p2", F.shiftright("conv", CHUNK_BITS).alias("piece")).agg(ids.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, key, digest = ["d", "p1", "p2", "ends_sha256"], None, None

        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.string()])], names)

        for batch in batches:
            done = []
            for d, p1, p2, _, text in zip(*[c.to_pylist() for c in batch.columns]):
                if (d, p1, p2) != key:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = (d, p1, p2), hashlib.sha256(text.encode())
                else:
                    digest.update(b"," + text.encode())
            yield table(done)
        if key is not None:
            yield table([(*key, digest.hexdigest())])

    placed = pieces.repartition("d", "p1", "p2").sortWithinPartitions("d", "p1", "p2", "piece")
    return placed.mapInArrow(run, "d long, p1 long, p2 long, ends_sha256 string")


def prefix_trie(chat: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, each = rebuild(chat)
    grouped = group_blocks(cut_blocks(turns))
    apart = grouped.where("NOT alike").select("conv", "blk", "size", F.explode("items").alias("t"))
    diverged = stored(apart.select("conv", "blk", "size", "t.d", "t.p1", "t.p2", "t.q1", "t.q2", "t.chars"), "diverged")
    nodes = nodes_of(grouped, diverged)
    sums = subtree_sums(nodes, grouped, diverged)
    zero = [F.lit(0).cast("long").alias(c) for c in ("d", "p1", "p2")]
    none = F.lit(None).cast("long")
    booked = each.select(F.col("conv").alias("rep"), F.lit(1).alias("n"), F.lit(0).alias("v"), F.lit(0).alias("u"))
    booked = booked.unionByName(nodes.select(none.alias("rep"), F.lit(0).alias("n"), "v", "u"))
    root = booked.agg(
        F.min("rep").alias("rep"), F.sum("n").alias("n"), F.sum("v").alias("saved"), F.greatest(F.sum("u"), F.lit(1)).alias("leaves")
    ).where("n > 0")
    below = nodes.select("d", "p1", "p2", "q1", "q2", "rep", "n").join(sums, ["d", "p1", "p2"])
    top = root.select(*zero, none.alias("q1"), none.alias("q2"), "rep", "n", "saved", "leaves")
    every = stored(below.unionByName(top), "sums")
    children = every.where("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("q1").alias("p1"), F.col("q2").alias("p2"))
    parents = every.select((F.col("d") + 1).alias("d"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("rep").alias("parent_conv_id"))
    ends = grouped.where("zd = size").select(F.col("zd").alias("d"), F.col("z1").alias("p1"), F.col("z2").alias("p2"), "conv")
    ends = ends.unionByName(each.where("size = 0").select(*zero, "conv"))
    rows = every.join(children.agg(F.count("*").alias("n_children")), ["d", "p1", "p2"], "left")
    rows = rows.join(end_digests(ends), ["d", "p1", "p2"], "left").join(parents, ["d", "q1", "q2"], "left")
    return rows.select(
        F.col("rep").alias("conv_id"), F.col("d").alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"),
        F.coalesce("n_children", F.lit(0)).alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
