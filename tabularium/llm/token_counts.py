"""Token counts of whole texts by a two-tier lookup of pre-token lengths, without a shuffle of texts.

A byte-level tokenizer cuts a text into pre-tokens and encodes each on its own, so a text has as
many ids as its pre-tokens have together. One pass finds the pre-tokens that are frequent in all
texts: every task keeps bounded counts and hands on its most frequent pre-tokens, which only
decides what the table holds and never a result. The second pass looks every pre-token up in the
broadcast table of at most ``FREQUENT`` keys of at most ``KEY_BYTES`` bytes, then among the
pre-tokens that the task has met before; the tokenizer encodes what is left, once per batch.

Special strings inside texts count as the library takes them by default: one id each. Texts with
characters of which Unicode versions may think differently are cut by the library itself.

Null and empty texts have no tokens. Long texts are cut where a single space parts two words,
which is always a pre-token boundary, and counted part by part. Rows are counted one by one:
repeated or null ids stay as they are. Other columns are ignored. An empty table gives none.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm import words as W

FREQUENT = 1 << 15  # pre-tokens in the broadcast table
KEY_BYTES = 48  # of one of them: the table never exceeds FREQUENT * (KEY_BYTES + 2) bytes
COUNTERS = 1 << 17  # pre-tokens that a task counts at once
CACHE = 1 << 19  # missed pre-tokens whose lengths a task keeps
CACHED_CHARS = 256  # longer pre-tokens are encoded each time
PART = 1 << 18  # characters of a text cut at once
HELD = 1 << 17  # pre-tokens looked up at once
SLICE_BYTES = 1 << 20
# The pattern of byte-level pre-tokenization (a fixed value of the tokenizer format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Ranges of characters that both Unicode tables class alike; texts with others are cut by the library.
USUAL = [(0x00, 0x557), (0x1E00, 0x1FFF), (0x2000, 0x205F), (0x20A0, 0x20B8), (0x2100, 0x214F), (0x3000, 0x3096), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3)]
UNUSUAL = "[^" + "".join(f"{chr(a)}-{chr(b)}" for a, b in USUAL) + "]"


class PreTokens:
    """Cuts texts as a byte-level tokenizer file says; other kinds of tokenizer are an error."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        said = json.loads(self.tokenizer.to_str())
        cutter = said["pre_tokenizer"] or {}
        if cutter.get("type") != "ByteLevel" or cutter["add_prefix_space"] or not cutter["use_regex"] or said["normalizer"]:
            raise ValueError("only byte-level tokenizers without a normalizer cut texts into independent pre-tokens")
        added = sorted((a["content"] for a in said["added_tokens"]), key=len, reverse=True)
        if any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in said["added_tokens"]):
            raise ValueError("added tokens that take their surroundings are not supported")
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.pattern, self.unusual = regex.compile(PATTERN), regex.compile(UNUSUAL)
        self.cut = regex.compile(r"(?<=\S) (?=\S)")

    def parts(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text in bounded lists; a special string is a list of its own."""
        at = 0
        for found in self.added.finditer(text) if self.added else ():
            yield from self._plain(text[at : found.start()])
            yield [found.group()]
            at = found.end()
        yield from self._plain(text[at:] if at else text)

    def _plain(self, text: str) -> Iterator[list[str]]:
        start = 0
        while start < len(text):
            found = self.cut.search(text, start + PART) if len(text) - start > PART else None
            end = found.start() if found else len(text)
            if self.unusual.search(text, start, end):
                piece = text[start:end]
                yield [piece[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(piece)]
            else:
                yield self.pattern.findall(text, start, end)
            start = end

    def lengths(self, pieces: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]


def frequent_lengths(docs: DataFrame, tokenizer: str) -> tuple[list[str], np.ndarray]:
    """The most frequent pre-tokens of all texts and their numbers of tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts = PreTokens(tokenizer), Counter()
        for batch in batches:
            for piece in W.slices(batch, limit=SLICE_BYTES):
                for text in piece.column("text").drop_null().to_pylist():
                    for part in own.parts(text):
                        counts.update(part)
                if len(counts) > COUNTERS:
                    counts = Counter(dict(counts.most_common(COUNTERS // 4)))
        most = [(p, n) for p, n in counts.most_common(FREQUENT // 4) if n > 1 and len(p.encode()) <= KEY_BYTES]
        columns = [pa.array([p for p, _ in most], pa.string()), pa.array([n for _, n in most], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["piece", "n"])

    met = docs.select("text").mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    rows = met.orderBy(F.desc("n"), "piece").limit(FREQUENT).select("piece").collect()  # at most FREQUENT short strings
    pieces = [r.piece for r in rows]
    return pieces, np.array(PreTokens(tokenizer).lengths(pieces), np.uint16)


class Lengths:
    """Numbers of tokens: the broadcast table first, then what the task has met, then the tokenizer."""

    def __init__(self, tokenizer: str, pieces: list[str], lengths: np.ndarray):
        self.own = PreTokens(tokenizer)
        self.frequent = dict(zip(pieces, lengths.tolist()))
        self.known = dict(self.frequent)

    def counts(self, texts: list[str]) -> list[int]:
        totals, held, size = [0] * len(texts), [], 0
        for row, text in enumerate(texts):
            for part in self.own.parts(text):
                held.append((row, part))
                size += len(part)
                if size > HELD:
                    self._add(held, totals)
                    held, size = [], 0
        self._add(held, totals)
        return totals

    def _add(self, held: list[tuple[int, list[str]]], totals: list[int]) -> None:
        fresh = list(set().union(*[part for _, part in held]) - self.known.keys())
        self.known.update(zip(fresh, self.own.lengths(fresh)))
        for row, part in held:
            totals[row] += sum(map(self.known.__getitem__, part))
        for piece in fresh:
            if len(piece) > CACHED_CHARS:
                self.known.pop(piece, None)
        if len(self.known) > FREQUENT + CACHE:
            self.known = dict(self.frequent)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every row."""
    held = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, tokenizer))  # at most FREQUENT short keys

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        own = Lengths(tokenizer, *held.value)
        for batch in batches:
            for piece in W.slices(batch, limit=SLICE_BYTES):
                text = piece.column("text").fill_null("")
                n = np.array(own.counts(text.to_pylist()), np.int64)
                columns = [piece.column("doc_id"), pc.binary_length(text).cast(pa.int64()), pa.array(n), pa.array(n > limit)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
