"""Substring removal with repeated-phrase automata.

A window is ``width`` consecutive words of one document. A word is removed if a window that
covers it also starts in a document with a smaller id; windows are judged on the input.

1. Every task hashes the windows of its documents and packs them, by hash range, into one blob
   per Arrow batch and range, so the shuffle moves few rows and 7 bytes a window.
2. Each range is sorted on its own; windows that start in two documents or more are confirmed,
   and each later document learns which of its windows are. Hashing spreads the windows of hot
   passages and hot copies over all ranges.
3. Documents and their confirmed windows meet in shards of about ``SHARD_BYTES`` of text, dealt
   by a hash of the id. A shard compiles one Aho-Corasick automaton (pyahocorasick, over word
   numbers) of its distinct passages, runs of confirmed windows, and streams all its documents
   through it; an occurrence counts if all its windows are confirmed for that document.

Null texts have no words. Texts shorter than a window are kept whole. Rows with a null id are
neither owners nor changed. Rows that repeat an id have no smaller id among each other, so both
are kept alike. Very long texts are one member of their shard. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm import words as W

WIDTH = 13
RANGE_BYTES = 24 << 20  # text whose windows make up one range of hashes
SHARD_BYTES = 6 << 20  # text of one automaton shard
STATS = "n_words long, n_removed long, kept_sha256 string"


def _pack(values: np.ndarray) -> bytes:
    """The low 7 bytes of 64-bit numbers."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def _unpack(raw: bytes, high: int) -> np.ndarray:
    """Numbers from their low 7 bytes and the common high one."""
    out = np.zeros((len(raw) // 7, 8), np.uint8)
    out[:, :7] = np.frombuffer(raw, np.uint8).reshape(-1, 7)
    out[:, 7] = high
    return out.reshape(-1).view("<u8").astype(np.uint64)


def _window_blobs(docs: DataFrame, width: int, bits: int) -> DataFrame:
    """(range, high, ids, sizes, windows): the distinct windows of each document, by hash range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for part in W.slices(batch):
                w = W.split(part.column("text"))
                at, windows = W.windows(w, W.hashes(w), width)
                key = part.column("id").to_numpy()[w.doc[at]]
                order = np.lexsort((windows, key))
                key, windows = key[order], windows[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (windows[1:] != windows[:-1])
                ids.append(key[new])
                found.append(windows[new])
            if not ids or not sum(map(len, ids)):
                continue
            key, windows = np.concatenate(ids), np.concatenate(found)
            # The high byte is shared by a blob; ranges are its first bits and those after it.
            place = (windows >> np.uint64(64 - max(bits, 8))).astype(np.int64)
            order = np.argsort(place, kind="stable")
            key, windows, place = key[order], windows[order], place[order]
            cuts = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1, [len(place)]])
            rows: dict[str, list] = {"range": [], "high": [], "ids": [], "sizes": [], "windows": []}
            for i, j in zip(cuts[:-1], cuts[1:]):
                first = np.concatenate([[0], np.flatnonzero(key[i + 1 : j] != key[i : j - 1]) + 1])
                rows["range"].append(int(windows[i] >> np.uint64(64 - bits)) if bits else 0)
                rows["high"].append(int(windows[i] >> np.uint64(56)))
                rows["ids"].append(key[i + first].tobytes())
                rows["sizes"].append(np.diff(np.append(first, j - i)).astype(np.int32).tobytes())
                rows["windows"].append(_pack(windows[i:j]))
            yield pa.record_batch(list(map(pa.array, rows.values())), names=list(rows))

    return docs.mapInArrow(run, "range long, high long, ids binary, sizes binary, windows binary")


def _later(ids: list[np.ndarray], windows: list[np.ndarray], shards: int) -> Iterator[pa.RecordBatch]:
    """Of the windows of one range, those that a document shares with a smaller id, by shard."""
    key, found = np.concatenate(ids), np.concatenate(windows)
    order = np.lexsort((key, found))
    key, found = key[order], found[order]
    new = np.ones(len(key), bool)
    new[1:] = found[1:] != found[:-1]
    owner = key[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
    late = np.flatnonzero(key > owner)
    if len(late):
        key, found = key[late], found[late]
        place = (W.mix(key.view(np.uint64)) % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((key, place))
        key, found, place = key[order], found[order], place[order]
        cuts = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1, [len(place)]])
        yield pa.record_batch({
            "shard": pa.array(place[cuts[:-1]]),
            "ids": pa.array([key[i:j].tobytes() for i, j in zip(cuts, cuts[1:])], pa.binary()),
            "windows": pa.array([found[i:j].tobytes() for i, j in zip(cuts, cuts[1:])], pa.binary()),
        })


def _confirmed(blobs: DataFrame, shards: int) -> DataFrame:
    """(shard, ids, windows): which windows of which documents start in an earlier document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, windows, now = [], [], None
        for batch in batches:
            for r, high, i, n, w in zip(*(c.to_pylist() for c in batch.columns)):
                if r != now and ids:
                    yield from _later(ids, windows, shards)
                    ids, windows = [], []
                now = r
                ids.append(np.repeat(np.frombuffer(i, np.int64), np.frombuffer(n, np.int32)))
                windows.append(_unpack(w, high))
        if ids:
            yield from _later(ids, windows, shards)

    dealt = blobs.repartition("range").sortWithinPartitions("range")
    return dealt.mapInArrow(run, "shard long, ids binary, windows binary")


def _runs(flags: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Word spans of the runs of flagged windows."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + width - 1))


def locate(w: W.Words, ids: np.ndarray, later: dict[int, np.ndarray], width: int) -> np.ndarray:
    """Which words of a shard lie in a passage that occurs in an earlier document."""
    hashed = W.hashes(w)
    at, windows = W.windows(w, hashed, width)
    flags = np.zeros(len(hashed) + 1, bool)
    bounds = np.searchsorted(w.doc[at], np.arange(len(ids) + 1))
    for k in np.flatnonzero(np.isin(ids, list(later))):
        here = slice(bounds[k], bounds[k + 1])
        flags[at[here][np.isin(windows[here], later[int(ids[k])])]] = True
    numbers = np.unique(hashed, return_inverse=True)[1].astype(np.int64)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
    for a, b in _runs(flags[:-1], width):  # a run never leaves its document: its windows do not
        automaton.add_word(tuple(numbers[a:b].tolist()))
    removed = np.zeros(len(hashed), bool)
    if not len(automaton):
        return removed
    automaton.make_automaton()
    clean = np.concatenate([[0], np.cumsum(~flags[:-1])])
    for k in range(len(ids)):
        first = w.first[k]
        for end, size in automaton.iter(tuple(numbers[first : w.first[k + 1]].tolist())):
            stop = first + end + 1
            if clean[stop - width + 1] == clean[stop - size]:
                removed[stop - size : stop] = True
    return removed


def _rows(docs: pa.Table, later: pa.Table, width: int) -> Iterator[tuple[pa.RecordBatch, W.Words, np.ndarray]]:
    """The documents of a shard in slices, with their words and which of them go."""
    key = np.concatenate([np.frombuffer(x, np.int64) for x in later.column("ids").to_pylist()] or [np.zeros(0, np.int64)])
    found = np.concatenate([np.frombuffer(x, np.uint64) for x in later.column("windows").to_pylist()] or [np.zeros(0, np.uint64)])
    order = np.argsort(key, kind="stable")
    key, found = key[order], found[order]
    starts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1]) if len(key) else np.zeros(0, int)
    owned = {int(key[i]): part for i, part in zip(starts, np.split(found, starts[1:]))} if len(key) else {}
    for batch in docs.combine_chunks().to_batches():
        for part in W.slices(batch):
            w = W.split(part.column("text"))
            ids = part.column("id").fill_null(-(1 << 63)).to_numpy()
            yield part, w, locate(w, ids, owned, width)


def remove_repeats(docs: DataFrame, width: int = WIDTH, rewrite: bool = False) -> DataFrame:
    """doc_id and statistics of every row, or with ``rewrite`` all rows with the words that stay.

    Rewritten texts are the kept words joined by one space; texts of which nothing goes, and
    null texts, stay as they are.
    """
    names = docs.columns
    kind = docs.schema["doc_id"].dataType.simpleString()
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(3, int(total // RANGE_BYTES).bit_length())
    shards = int(max(1, total // SHARD_BYTES))
    keyed = docs.select(F.col("doc_id").cast("long").alias("id"), *([F.struct(*names).alias("row")] if rewrite else []), "text")
    blobs = _window_blobs(keyed.where("id is not null and text is not null").select("id", "text"), width, bits)
    later = _confirmed(blobs, shards)

    def shard_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").fill_null(0).to_numpy().copy()
            lost = np.flatnonzero(batch.column("id").is_null().to_numpy(zero_copy_only=False))
            ids[lost] = lost  # rows without an id go anywhere
            place = (W.mix(ids.view(np.uint64)) % np.uint64(shards)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(place), *batch.columns], ["shard", *batch.schema.names])

    inside = "id long, " + (f"row {keyed.schema['row'].dataType.simpleString()}, " if rewrite else "") + "text string"
    dealt = keyed.mapInArrow(shard_of, f"shard long, {inside}")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for part, w, removed in _rows(left, right, width):
            texts, sums = [], []
            gone = np.concatenate([[0], np.cumsum(removed)])
            for k in range(part.num_rows):
                a, b = w.first[k], w.first[k + 1]
                kept = b" ".join(w.data[w.starts[i] : w.ends[i]].tobytes() for i in a + np.flatnonzero(~removed[a:b]))
                texts.append(kept)
                sums.append(hashlib.sha256(kept).hexdigest())
            lost = gone[w.first[1:]] - gone[w.first[:-1]]
            if not rewrite:
                columns = [part.column("id"), pa.array(np.diff(w.first)), pa.array(lost), pa.array(sums, pa.string())]
                out.append(pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_removed", "kept_sha256"]))
                continue
            row = part.column("row")
            fields = {f.name: row.field(i) for i, f in enumerate(row.type)}
            old = fields["text"].to_pylist()
            fields["text"] = pa.array([t if not n or t is None else k.decode() for t, n, k in zip(old, lost, texts)], pa.string())
            out.append(pa.RecordBatch.from_arrays(list(fields.values()), list(fields)))
        return pa.Table.from_batches(out) if out else pa.table({n: pa.array([], t) for n, t in empty.items()})

    if rewrite:
        schema = docs.schema
        empty = {}
    else:
        schema = f"id long, {STATS}"
        empty = {"id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string()}
    out = dealt.groupBy("shard").cogroup(later.groupBy("shard")).applyInArrow(finish, schema)
    return out if rewrite else out.select(F.col("id").cast(kind).alias("doc_id"), "n_words", "n_removed", "kept_sha256")
