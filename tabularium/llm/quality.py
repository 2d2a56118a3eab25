"""Quality rules: word statistics and compression bands of whole texts.

A text passes the base rules with at least 50 words of which at most half lie in repeated
3-word windows. It then passes the compression bands if the zstandard ratio (compressed over
plain UTF-8 bytes) of the whole text lies between the limits for its length, and so do those of
its fixed chunks: a low ratio is repetitive or formulaic text, a high one is noise. The least
ratio of the whole goes on falling with the length, so from a chunk on the chunks decide; the
last chunk ends with the text. Texts shorter than a chunk are cut into smaller pieces for noise.
Random letters compress like dense technical prose and count as noise from a third of the chunks.

Null and empty texts have no words and fail the base rules. Nothing depends on other rows, so
repeated rows and ties get equal verdicts, and every row is a row of the result; an empty table
gives an empty result. Very long texts are handled whole, one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tabularium.llm import words as W

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
LEVEL = 3
CHUNK = 2048
# UTF-8 bytes, least and largest ratio of the whole text: straight lines in the logarithm of the
# length between the rows, level before the first, and lower by FALL for each doubling after the last
BANDS = ((300, 0.500, 0.85), (600, 0.490, 0.79), (1_000, 0.475, 0.74), (1_500, 0.458, 0.72), (2_048, 0.444, 0.70))
FALL = 0.03  # prose falls by 0.01 to 0.02
CHUNK_BAND = (0.455, 0.68)  # more than half of the chunks reach the first, nine in ten stay within the second
CHUNK_FLOOR = 0.300  # and none below this
LETTERS, ASCII = 0.585, 0.75  # at most a third of chunks of so much ASCII is above: random letters
PIECE, PIECE_HIGH = 512, 0.80  # texts shorter than a chunk: nine in ten pieces stay within

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
VERDICT = "base_failed boolean, kept boolean, ratio double, reason string"
TYPES = {"ratio": pa.float64(), "reason": pa.string()}  # of columns that may be all null
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1


def _per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive bounds; empty stretches give 0."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _repeats(doc: np.ndarray, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For (text, hash) rows: whether an equal row exists, and whether an earlier one does."""
    order = np.lexsort((np.arange(len(doc)), hashed, doc))
    same = np.zeros(len(doc) + 1, bool)
    same[1:-1] = (doc[order][1:] == doc[order][:-1]) & (hashed[order][1:] == hashed[order][:-1])
    twice, again = np.zeros(len(doc), bool), np.zeros(len(doc), bool)
    twice[order] = same[1:] | same[:-1]
    again[order] = same[:-1]
    return twice, again


def statistics(w: W.Words) -> dict[str, np.ndarray]:
    """The base statistics of every text of a slice."""
    n = len(w.bounds) - 1
    hashed = W.hashes(w)
    point = (w.data & 0xC0) != 0x80
    solid = np.zeros(len(w.data) + 1, np.int64)
    np.add.at(solid, w.starts, 1)
    np.add.at(solid, w.ends, -1)
    in_word = np.cumsum(solid[:-1]) > 0
    at, three = W.windows(w, hashed, 3)
    twice, _ = _repeats(w.doc[at], three)
    repeated = W.covered(len(w.starts), at[twice], 3)

    breaks = np.flatnonzero(w.data == 10)
    starts = np.unique(np.concatenate([w.bounds[:-1], breaks + 1]))
    starts = starts[starts < len(w.data)]
    line_doc = np.searchsorted(w.bounds, starts, side="right") - 1
    stops = np.minimum(np.append(starts[1:], len(w.data)), w.bounds[line_doc + 1])
    ends = stops - ((stops > starts) & (w.data[np.maximum(stops - 1, 0)] == 10))
    filled = np.searchsorted(w.starts, ends) > np.searchsorted(w.starts, starts)
    starts, ends, line_doc = starts[filled], ends[filled], line_doc[filled]
    _, again = _repeats(line_doc, W.span_hashes(w.data, starts, ends))
    return {
        "n_words": np.diff(w.first),
        "word_chars": _per_text(point & in_word, w.bounds),
        "n_symbols": _per_text(_SYMBOL[w.data], w.bounds),
        "n_dup_lines": np.bincount(line_doc[again], minlength=n),
        "n_repeat_words": np.bincount(w.doc[repeated], minlength=n),
    }


def whole_band(size: int) -> tuple[float, float]:
    """Least and largest ratio of a whole text of ``size`` bytes."""
    at, low, high = zip(*BANDS)
    spot, at = np.log2(size), np.log2(at)
    return float(max(0.0, np.interp(spot, at, low) - FALL * max(0.0, spot - at[-1]))), float(np.interp(spot, at, high))


def pieces(text: bytes, size: int) -> list[bytes]:
    """Consecutive stretches of ``size`` bytes; the last ends with the text and may overlap its forerunner."""
    return [text[k : k + size] for k in (*range(0, len(text) - size, size), len(text) - size)] if len(text) >= size else []


def compression_reason(text: bytes, squeeze: zstandard.ZstdCompressor) -> tuple[float, str | None]:
    """Ratio of the whole text, and why the bands reject it, if they do."""
    ratio = len(squeeze.compress(text)) / len(text)
    low, high = whole_band(len(text))
    if ratio < low:
        return ratio, "repetitive"
    if ratio > high:
        return ratio, "incompressible"
    chunks = pieces(text, CHUNK)
    ratios = np.array([len(squeeze.compress(c)) / CHUNK for c in chunks])
    if not chunks:
        ratios = np.array([len(squeeze.compress(c)) / PIECE for c in pieces(text, PIECE)])
        return ratio, "incompressible chunks" if 10 * (ratios > PIECE_HIGH).sum() > len(ratios) else None
    if ratios.min() < CHUNK_FLOOR or 2 * (ratios < CHUNK_BAND[0]).sum() >= len(ratios):
        return ratio, "repetitive chunks"
    letters = [r > LETTERS and (np.frombuffer(c, np.uint8) < 128).mean() >= ASCII for r, c in zip(ratios, chunks)]
    if 10 * (ratios > CHUNK_BAND[1]).sum() > len(ratios) or 3 * sum(letters) > len(ratios):
        return ratio, "incompressible chunks"
    return ratio, None


def judge(texts: pa.Array) -> dict[str, np.ndarray | list]:
    """Statistics and verdict of each text of a slice."""
    w = W.split(texts)
    out: dict = statistics(w)
    few = out["n_words"] < MIN_WORDS
    failed = few | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * out["n_words"])
    squeeze = zstandard.ZstdCompressor(level=LEVEL)
    ratios: list[float | None] = []
    reasons: list[str | None] = []
    for i in range(len(failed)):
        ratio, reason = None, None
        if few[i]:
            reason = "few words"
        elif failed[i]:
            reason = "repeated words"
        else:
            ratio, reason = compression_reason(w.data[w.bounds[i] : w.bounds[i + 1]].tobytes(), squeeze)
        ratios.append(ratio)
        reasons.append(reason)
    return out | {"base_failed": failed, "kept": np.array([r is None for r in reasons], bool), "ratio": ratios, "reason": reasons}


def quality_rules(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: its key, statistics and verdict."""
    kind = docs.schema[key].dataType.simpleString()
    names = [f.split()[0] for f in f"{STATS}, {VERDICT}".split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "_text"):
                found = judge(part.column("_text"))
                columns = [part.column("_key"), *(pa.array(found[n], TYPES.get(n)) for n in names)]
                yield pa.RecordBatch.from_arrays(columns, [key, *names])

    picked = docs.select(docs[key].alias("_key"), docs[text].alias("_text"))
    return picked.mapInArrow(run, f"`{key}` {kind}, {STATS}, {VERDICT}")


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, text):
                yield part.filter(pa.array(judge(part.column(text))["kept"]))

    return docs.mapInArrow(run, docs.schema)
