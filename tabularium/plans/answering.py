"""Question batches: classify, retrieve, assemble the context, answer, judge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.functions.text import clean_sentences, strip_markers
from tabularium.operators.chunking import context_budget
from tabularium.operators.grounding import enough_context, extract_by_words, gate, grounding_score
from tabularium.operators.intents import live_context
from tabularium.operators.retrieval import assemble_context, hybrid_retrieve
from tabularium.session import stored
from tabularium.vocabulary import NO_CONTEXT


def contexts(
    questions: DataFrame,
    corpus: DataFrame,
    namespaces: DataFrame,
    metrics: DataFrame | None = None,
    top_k: int = 5,
) -> DataFrame:
    """query_id, intent, confidence, context and sources for every question."""
    picks = stored(hybrid_retrieve(questions, corpus, namespaces, top_k), "picks")
    asked = picks.select("query_id", "intent", "confidence").distinct()
    live = live_context(asked, metrics) if metrics is not None else None
    built = assemble_context(picks.select("query_id", "doc_id", "pick"), corpus, live)
    return asked.join(built, "query_id")


def answer(questions: DataFrame, built: DataFrame) -> DataFrame:
    """Extractive answers from the markers-free, budgeted context."""
    facts = F.array_join(context_budget(clean_sentences(strip_markers(F.col("context")))), "\n")
    return built.join(questions.select("query_id", "text"), "query_id").select(
        "query_id",
        "intent",
        "confidence",
        facts.alias("facts"),
        "sources",
        F.when(enough_context(F.col("context")), extract_by_words(F.col("text"), facts)).otherwise(F.lit(NO_CONTEXT)).alias("answer"),
    )


def judge(answers: DataFrame) -> DataFrame:
    """Grounding score and gate decision of given answers against their facts."""
    scored = answers.withColumn("grounding", grounding_score(F.col("answer"), F.col("facts")))
    return scored.withColumn("decision", gate(F.col("grounding"), F.col("answer")))
