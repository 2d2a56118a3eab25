"""Grounding of answers in their context, the acceptance gate and extractive answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.functions.text import clean_sentences, content_tokens, is_hedged, tokens
from tabularium.functions.vectors import cosine
from tabularium.vocabulary import (
    CONTEXT_MIN_WORDS,
    EXTRACT_MIN_COSINE,
    EXTRACT_MIN_OVERLAP,
    GROUNDING_REJECT,
    GROUNDING_REVIEW,
    NO_ANSWER,
    NO_CONTEXT,
)


def grounding_score(answer: Column, context: Column) -> Column:
    """Share of the answer's content words (repeats counted) that occur in the context."""
    said = content_tokens(tokens(F.coalesce(answer, F.lit(""))))
    known = F.array_distinct(content_tokens(tokens(F.coalesce(context, F.lit("")))))
    found = F.size(F.filter(said, lambda w: F.array_contains(known, w)))
    return F.when(F.size(said) == 0, F.lit(0.0)).otherwise(found / F.size(said))


def gate(score: Column, answer: Column) -> Column:
    """accept, extractive or needs_review (where a judge would decide)."""
    return (
        F.when(score < GROUNDING_REJECT, "extractive")
        .when(is_hedged(answer), "extractive")
        .when(score < GROUNDING_REVIEW, "needs_review")
        .otherwise("accept")
    )


def enough_context(context: Column, least: int = CONTEXT_MIN_WORDS) -> Column:
    """Whether a context has the words that an answer needs; null has none."""
    return F.regexp_count(F.coalesce(context, F.lit("")), F.lit(r"\S+")) >= least


def answer_or_refuse(question: Column, context: Column) -> Column:
    """The extractive answer, or the fixed refusal where the context is too short for one."""
    return F.when(enough_context(context), extract_by_words(question, context)).otherwise(F.lit(NO_CONTEXT))


def extract_by_words(question: Column, context: Column) -> Column:
    """The first sentence with the most distinct question words; fewer than two abstains."""
    asked = F.array_distinct(tokens(F.coalesce(question, F.lit(""))))
    scored = F.transform(
        clean_sentences(F.coalesce(context, F.lit(""))),
        lambda s, i: F.struct(
            F.size(F.array_intersect(asked, tokens(s))).alias("score"),
            (-i).alias("order"),
            s.alias("sentence"),
        ),
    )
    best = F.array_max(scored)
    return F.when(
        F.coalesce(best["score"], F.lit(0)) >= EXTRACT_MIN_OVERLAP, best["sentence"]
    ).otherwise(F.lit(NO_ANSWER))


def extract_by_vector(pairs: DataFrame, question_id: str) -> DataFrame:
    """Best sentence per question by cosine over (question_vector, vector, pos, sentence) rows."""
    score = cosine(F.col("question_vector"), F.col("vector"))
    best = pairs.withColumn("score", score).groupBy(question_id).agg(
        F.max_by("sentence", F.struct("score", -F.col("pos"))).alias("sentence"),
        F.max("score").alias("score"),
    )
    return best.withColumn(
        "answer",
        F.when(F.col("score") < EXTRACT_MIN_COSINE, F.lit(NO_ANSWER)).otherwise(F.col("sentence")),
    ).drop("sentence")
