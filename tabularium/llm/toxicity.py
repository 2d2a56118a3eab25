"""Toxicity by compression distance: two zstandard dictionaries, one per class of text.

Both dictionaries share a body of frequent ordinary words at the same offsets. Before it, the
toxic one holds the stems that training documents of the toxic class use in many different
contexts and ordinary ones do not; the other holds further ordinary words of the same size.
Windows of words are compressed with both, and the lengths saved by the toxic dictionary are
summed up per text (largest, sum, counts above thresholds). A logistic regression, fitted on
other labelled documents than the dictionaries, turns these into a score from 0 to 1.

Fitting takes at most ``DICTIONARY_DOCS`` and ``CALIBRATION_DOCS`` labelled rows, chosen by a
hash of the id, so the sample that one task takes is bounded; every text is scored whole.
Null and empty texts have no windows and get the score of a text without any saving. Repeated
rows get equal scores. Without labelled rows of both classes every score is the smoothed share
of toxic rows. Ids that are null are never trained on. An empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm import words as W

FOLDS = 5
DICTIONARY_DOCS = {1: 1200, 0: 2000}  # labelled rows per class for the dictionaries
CALIBRATION_DOCS = 5000  # labelled rows for the regression
WINDOWS = (24, 10)  # words
DICTIONARY_BYTES = 32 << 10
STEM_BYTES = (4, 5, 6, 7, 1 << 30)  # prefixes of words taken as stems; the last is the whole word
MIN_CONTEXTS = 8
MIN_Z = 15.0
LEVEL, MIN_MATCH = 6, 5
LIMITS = (1, 2, 3, 4, 6)  # bytes saved


class Model(NamedTuple):
    dictionaries: tuple[bytes, bytes]  # ordinary, toxic
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the first is the constant


def _counts(w: W.Words, hashed: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stems of ``size`` bytes: hash, number of different preceding words, a word that has it."""
    before = np.concatenate([[np.uint64(0)], hashed[:-1]])
    before[w.first[:-1][w.first[:-1] < len(hashed)]] = 0
    long = np.flatnonzero(w.ends - w.starts >= min(size, STEM_BYTES[0]))
    stems = W.span_hashes(w.data, w.starts[long], np.minimum(w.starts[long] + size, w.ends[long]))
    _, first = np.unique(W.mix(stems + np.uint64(3) * before[long]), return_index=True)
    found, at, n = np.unique(stems[first], return_index=True, return_counts=True)
    return found, n, long[first[at]]


def _pack(stems: list[bytes], size: int) -> bytes:
    """Stems with a space before each, the first one last, up to ``size`` bytes."""
    out, used = [], 0
    for s in stems:
        used += len(s) + 1
        if used > size:
            break
        out.append(b" " + s)
    return b"".join(reversed(out))


def train_dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """Contents of the ordinary and the toxic dictionary."""
    parts = []
    for texts in (ordinary, toxic):
        w = W.split(pa.array(sorted(set(texts)), pa.string()))
        parts.append((w, W.hashes(w)))
    scored = []
    for size in STEM_BYTES:
        known, other, _ = _counts(*parts[0], size)
        found, n, at = _counts(*parts[1], size)
        where = np.minimum(np.searchsorted(known, found), max(len(known) - 1, 0))
        plain = np.where(known[where] == found, other[where], 0) if len(known) else np.zeros(len(found), int)
        share = len(parts[1][1]) / max(1, len(parts[0][1]) + len(parts[1][1]))
        expected = (n + plain) * share
        z = (n - expected) / np.sqrt(expected * (1 - share) + 1e-9)
        rare = n * max(1, len(parts[0][1])) > 10 * plain * max(1, len(parts[1][1]))
        w = parts[1][0]
        for i in np.flatnonzero((n >= MIN_CONTEXTS) & rare & (z >= MIN_Z * np.sqrt(share))):
            a = w.starts[at[i]]
            scored.append((-z[i], w.data[a : min(a + size, w.ends[at[i]])].tobytes(), n[i]))
    stems: list[bytes] = []
    for _, s, n in sorted(scored):
        if not any(s.startswith(t) or t.startswith(s) for t in stems):
            # of the longer stems that are nearly as frequent, the longest saves most
            stems.append(max((t for _, t, m in scored if t.startswith(s) and 10 * m >= 9 * n), key=len))
    w = parts[0][0]
    found, n, at = _counts(*parts[0], STEM_BYTES[-1])
    common = [w.data[w.starts[k] : w.ends[k]].tobytes() for k in at[np.argsort(-n, kind="stable")][:8000]]
    own = _pack(stems, DICTIONARY_BYTES // 8)
    body = _pack(common, DICTIONARY_BYTES - len(own))
    rest = _pack(common[len(common) // 2 :], len(own)).ljust(len(own), b".")
    return rest + body, own + body


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    fixed = {"min_match": MIN_MATCH, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    setting = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=256, dict_size=DICTIONARY_BYTES, **fixed)
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=setting)


def _lengths(squeeze: zstandard.ZstdCompressor, raw: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    spans = np.stack([starts, sizes], 1).astype(np.uint64).tobytes()
    out = squeeze.multi_compress_to_buffer(zstandard.BufferWithSegments(raw, spans), threads=0)
    return np.fromiter((len(x) for x in out), np.int64, len(out))


def features(w: W.Words, squeezers: list[zstandard.ZstdCompressor]) -> np.ndarray:
    """What the toxic dictionary saves on the windows of each text."""
    n = len(w.bounds) - 1
    columns = [np.log1p(np.diff(w.first))]
    raw = w.data.tobytes()
    for width in WINDOWS:
        place = np.arange(len(w.starts)) - w.first[:-1][w.doc]
        start = np.flatnonzero(place % width == 0)
        stop = np.append(start[1:], len(place)) - 1
        saved, doc = np.zeros(0, np.int64), w.doc[start]
        if len(start):
            sizes = w.ends[stop] - w.starts[start]
            plain, toxic = (_lengths(s, raw, w.starts[start], sizes) for s in squeezers)
            saved = plain - toxic
        largest = np.zeros(n)
        np.maximum.at(largest, doc, saved)
        columns += [largest, np.log1p(np.bincount(doc, np.maximum(saved, 0), minlength=n))]
        columns += [np.log1p(np.bincount(doc[saved >= k], minlength=n)) for k in LIMITS]
        columns.append(np.bincount(doc, saved, minlength=n) / np.maximum(1, np.bincount(doc, minlength=n)))
    return np.stack(columns, 1)


def _regression(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression by Newton steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    weights, penalty = np.zeros(x.shape[1]), np.diag([1e-3] + [ridge] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + penalty, x.T @ (y - p) - penalty @ weights)
        weights += step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def fit(toxic: list[str], ordinary: list[str], calibration: list[tuple[str, int]]) -> Model:
    """Dictionaries from two lists of texts, the regression from (text, label) pairs."""
    plain, marked = train_dictionaries(toxic, ordinary) if toxic and ordinary else (b" " * 64, b" " * 64)
    squeezers = [_compressor(plain), _compressor(marked)]
    y = np.array([label for _, label in calibration], float)
    table = pa.record_batch({"text": pa.array([t for t, _ in calibration], pa.string())})
    rows = [features(W.split(part.column("text")), squeezers) for part in W.slices(table)]
    if not rows or y.min() == y.max() or not toxic or not ordinary:
        width = 1 + len(WINDOWS) * (len(LIMITS) + 3)
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Model((plain, marked), np.zeros(width), np.ones(width), np.array([np.log(share / (1 - share))] + [0.0] * width))
    x = np.concatenate(rows)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    return Model((plain, marked), mean, scale, _regression((x - mean) / scale, y))


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, text and toxic of the rows fitting takes: in each part the first by a hash of the id, ties by text.

    The ids of all labelled rows give the last hash that each part takes; only the texts of rows
    up to it meet their labels, so no other text is shuffled.
    """
    fold, rank = _fold(F.col("doc_id")), F.xxhash64("doc_id")
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(fold != 0)
    parts = [("calibration", F.col("fold") > 2, CALIBRATION_DOCS)]
    parts += [("dictionary", F.col("fold").isin(1, 2) & (F.col("toxic") == label), n) for label, n in DICTIONARY_DOCS.items()]
    keys = docs.select("doc_id").join(known, "doc_id").select(fold.alias("fold"), rank.alias("rank"), "toxic")
    cuts = [keys.where(where).orderBy("rank").limit(n).agg(F.max("rank").alias("cut")).select(F.lit(k).alias("k"), "cut") for k, (_, where, n) in enumerate(parts)]
    cut = dict(cuts[0].union(cuts[1]).union(cuts[2]).collect())

    sample = None
    for k, (part, where, n) in enumerate(parts):
        rows = docs.where(rank <= F.lit(cut[k]).cast("long")).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(known, "doc_id")
        rows = rows.select(fold.alias("fold"), rank.alias("rank"), "text", "toxic").where(where)
        first = rows.orderBy("rank", "text").limit(n).select(F.lit(part).alias("part"), "text", "toxic")
        sample = first if sample is None else sample.union(first)
    return sample


def fit_labelled(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on bounded samples of the labelled rows that are not held out."""
    sample = labelled_sample(docs, labels)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict = {("dictionary", 0): [], ("dictionary", 1): []}
        calibration = []
        for batch in batches:
            for part, text, label in zip(*(batch.column(c).to_pylist() for c in ("part", "text", "toxic"))):
                calibration.append((text, label)) if part == "calibration" else texts[part, label].append(text)
        model = fit(texts["dictionary", 1], texts["dictionary", 0], calibration)
        yield pa.record_batch({"model": pa.array([pickle.dumps(tuple(model))], pa.binary())})

    # The sample is bounded: one task fits the model, and the driver only sees the result.
    found = sample.repartition(1).mapInArrow(train, "model binary").first()
    return Model(*pickle.loads(found.model)) if found else fit([], [], [])


def _fold(key):
    return F.crc32(key.cast("string").cast("binary")) % FOLDS


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeezers = [_compressor(d) for d in model.dictionaries]
        for batch in batches:
            for part in W.slices(batch):
                x = (features(W.split(part.column("text")), squeezers) - model.mean) / model.scale
                p = 1 / (1 + np.exp(-np.clip(model.weights[0] + x @ model.weights[1:], -30, 30)))
                columns = [part.column("doc_id"), part.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    picked = docs.select("doc_id", F.coalesce(_fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "text")
    return picked.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")
