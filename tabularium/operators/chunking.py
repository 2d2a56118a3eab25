"""Documents to chunks. Each document is folded inside its own row: no shuffle, whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.functions.text import sentences, words
from tabularium.vocabulary import CHUNK_OVERLAP, CHUNK_WORDS, CONTEXT_WORDS, WINDOW_STEP, WINDOW_WORDS


def sentence_chunks(
    docs: DataFrame,
    doc_id: str,
    title: str,
    content: str,
    limit: int = CHUNK_WORDS,
    overlap: int = CHUNK_OVERLAP,
) -> DataFrame:
    """Sentence-aware chunks: doc id, title, chunk_index, content.

    A header names the document. Sentences are packed up to ``limit`` words; the next chunk
    starts with the last ``overlap`` words of the one before. A longer sentence stays whole.
    """
    full = F.concat(F.lit("DOCUMENT: "), F.col(title), F.lit("\n\n"), F.col(content))
    pieces = F.transform(sentences(full), words)
    no_words = F.array().cast("array<string>")
    start = F.struct(no_words.alias("cur"), F.array().cast("array<array<string>>").alias("done"))

    def add(acc, piece):
        cur = acc["cur"]
        over = (F.size(cur) + F.size(piece) > limit) & (F.size(cur) > 0)
        tail = F.slice(cur, F.greatest(F.size(cur) - overlap + 1, F.lit(1)), F.lit(overlap))
        return F.struct(
            F.when(over, F.concat(tail, piece)).otherwise(F.concat(cur, piece)).alias("cur"),
            F.when(over, F.concat(acc["done"], F.array(cur))).otherwise(acc["done"]).alias("done"),
        )

    def close(acc):
        return F.when(F.size(acc["cur"]) > 0, F.concat(acc["done"], F.array(acc["cur"]))).otherwise(
            acc["done"]
        )

    chunks = F.aggregate(pieces, start, add, close)
    return docs.select(
        doc_id, title, F.posexplode(chunks).alias("chunk_index", "_words")
    ).select(doc_id, title, "chunk_index", F.array_join("_words", " ").alias("content"))


def window_chunks(
    docs: DataFrame, doc_id: str, content: str, size: int = WINDOW_WORDS, step: int = WINDOW_STEP
) -> DataFrame:
    """Fixed windows of ``size`` words every ``step`` words: doc id, chunk_index, content."""
    w = docs.select(doc_id, words(F.col(content)).alias("_w")).where(F.size("_w") > 0)
    starts = F.sequence(F.lit(0), F.size("_w") - 1, F.lit(step))
    return w.select(doc_id, "_w", F.posexplode(starts).alias("chunk_index", "_at")).select(
        doc_id,
        "chunk_index",
        F.array_join(F.slice("_w", F.col("_at") + 1, F.lit(size)), " ").alias("content"),
    )


def context_budget(sents, limit: int = CONTEXT_WORDS):
    """The leading sentences that fit into ``limit`` words (stops at the first that does not)."""
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("kept"), F.lit(True).alias("open"))

    def add(acc, s):
        total = acc["total"] + F.size(words(s))
        fits = acc["open"] & (total <= limit)
        return F.struct(
            F.when(fits, total).otherwise(acc["total"]).alias("total"),
            F.when(fits, acc["kept"] + 1).otherwise(acc["kept"]).alias("kept"),
            fits.alias("open"),
        )

    return F.slice(sents, F.lit(1), F.aggregate(sents, start, add)["kept"])
