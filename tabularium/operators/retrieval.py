"""Batch retrieval: BM25, dense top-k, rank fusion, diversity re-ranking and hybrid routing.

Questions arrive as a table; every operator works on all of them at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularium.functions.text import tokens
from tabularium.functions.vectors import cosine
from tabularium.operators.intents import classify, route
from tabularium.operators.nearest import keep_best, nearest
from tabularium.session import stored
from tabularium.sources.registry import top_per
from tabularium.vocabulary import BM25_B, BM25_K1, MMR_LAMBDA, RRF_K

RANK_BLOCK = 1_000_000
RANK_BLOCKS = 50_000
MATRIX_CELLS = 4_000_000
JOINED_SPACE = 1_000
SCANNED_QUERIES = 1_024


def tokenise_corpus(corpus: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Stored (doc_id, dl, toks): the corpus is tokenised once, later reads are column-pruned."""
    toks = corpus.select(F.col(doc_id).alias("doc_id"), tokens(F.col(text)).alias("toks"))
    return stored(toks.select("doc_id", F.size("toks").alias("dl"), "toks"), "tokens")


def term_counts(tokenised: DataFrame) -> DataFrame:
    """(doc_id, dl, term, tf): tokens of a document are counted where the document is, unshuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column(2)
                row = pc.list_parent_indices(lists)
                flat = pa.table({"row": row, "term": pc.list_flatten(lists)})
                tf = flat.group_by(["row", "term"]).aggregate([([], "count_all")])
                if tf.num_rows == 0:
                    continue
                where = tf.column("row").combine_chunks()
                out = pa.table(
                    {
                        "doc_id": part.column(0).take(where),
                        "dl": part.column(1).take(where),
                        "term": tf.column("term").combine_chunks().cast(pa.string()),
                        "tf": tf.column("count_all").combine_chunks().cast(pa.int64()),
                    }
                )
                yield from out.to_batches()

    kind = dict(tokenised.dtypes)["doc_id"]
    return tokenised.select("doc_id", "dl", "toks").mapInArrow(
        count, f"doc_id {kind}, dl int, term string, tf bigint"
    )


def bm25(
    tokenised: DataFrame,
    queries: DataFrame,
    query_id: str,
    text: str,
    k1: float = BM25_K1,
    b: float = BM25_B,
) -> DataFrame:
    """(query_id, doc_id, score) of every document that shares a term with the query.

    Repeated query terms count repeatedly. The query side is a stored table, broadcast when its
    size allows. A document's terms are all in one task, so partial sums are complete before
    the one shuffle, which carries the result rows.
    """
    corpus = _corpus_size(tokenised)
    weights = _query_weights(tokenised, queries, query_id, text, corpus)
    tf = F.col("tf")
    part = tf * (k1 + 1) / (tf + k1 * (1 - b + b * (F.col("dl") / corpus["avgdl"])))
    return (
        term_counts(tokenised)
        .join(weights, "term")
        .groupBy("query_id", "doc_id")
        .agg(F.sum(F.col("w") * part).alias("score"))
    )


def bm25_topn(
    tokenised: DataFrame, queries: DataFrame, query_id: str, text: str, n: int
) -> DataFrame:
    """The ``n`` best positive scores per query; a query without words gets the first documents.

    Scores are compared at 9 digits, so copies of a document tie and the smaller id wins. A
    batch whose query × term matrix is small is scored inside the scan: every task keeps its
    own best ``n`` per query and no (query, document) pairs are shuffled. Larger batches, or
    documents without integer ids, go through the relational ``bm25``.
    """
    shape = (
        queries.select(F.col(query_id).alias("q"), F.explode(tokens(F.col(text))).alias("t"))
        .agg(F.count_distinct("q").alias("q"), F.count_distinct("t").alias("t"))
        .first()
    )
    integer_ids = dict(tokenised.dtypes)["doc_id"] in ("int", "bigint")
    if integer_ids and shape["q"] * shape["t"] <= MATRIX_CELLS:
        scored = _scan_scores(tokenised, queries, query_id, text, n)
    else:
        scored = bm25(tokenised, queries, query_id, text).withColumn("score", F.round("score", 9))
    best = top_per(
        scored.where(F.col("score") > 0), ["query_id"], [F.desc("score"), "doc_id"], n
    )
    wordless = queries.where(F.size(tokens(F.coalesce(F.col(text), F.lit("")))) == 0)
    first = tokenised.orderBy("doc_id").limit(n).select("doc_id")
    listed = first.agg(F.array_sort(F.collect_list("doc_id"))).scalar()
    fallback = wordless.select(
        F.col(query_id).alias("query_id"), F.posexplode(listed).alias("pos", "doc_id")
    ).select("query_id", "doc_id", F.lit(0.0).alias("score"), (F.col("pos") + 1).alias("rank"))
    return best.select("query_id", "doc_id", "score", "rank").unionByName(fallback)


def _query_weights(
    tokenised: DataFrame, queries: DataFrame, query_id: str, text: str, corpus: Column
) -> DataFrame:
    """Stored (query_id, term, w): idf times the count of the term in the query."""
    asked = stored(
        queries.select(F.col(query_id).alias("query_id"), F.explode(tokens(F.col(text))).alias("term"))
        .groupBy("query_id", "term")
        .agg(F.count("*").alias("qtf")),
        "query-terms",
    )
    df_ = F.col("df")
    frequencies = (
        tokenised.select(F.explode(F.array_distinct("toks")).alias("term"))
        .join(asked.select("term").distinct(), "term", "left_semi")
        .groupBy("term")
        .agg(F.count("*").alias("df"))
    )
    idf = F.log(1 + (corpus["n"] - df_ + 0.5) / (df_ + 0.5))
    weights = frequencies.select("term", idf.alias("idf")).join(asked, "term")
    return stored(
        weights.select("query_id", "term", (F.col("qtf") * F.col("idf")).alias("w")), "query-weights"
    )


def _corpus_size(tokenised: DataFrame) -> Column:
    return tokenised.agg(
        F.struct(F.count("*").cast("double").alias("n"), F.avg("dl").alias("avgdl"))
    ).scalar()


def _scan_scores(
    tokenised: DataFrame, queries: DataFrame, query_id: str, text: str, n: int
) -> DataFrame:
    """Best ``n`` (query_id, doc_id, score) per query and task; the weight matrix is shipped."""
    weights = _query_weights(tokenised, queries, query_id, text, _corpus_size(tokenised)).toPandas()
    avgdl = tokenised.agg(F.avg("dl")).first()[0] or 1.0
    ids, q_at = np.unique(weights["query_id"].to_numpy(dtype=np.int64), return_inverse=True)
    terms, t_at = np.unique(weights["term"].to_numpy(dtype=str), return_inverse=True)
    matrix = np.zeros((len(ids), len(terms)))
    matrix[q_at, t_at] = weights["w"].to_numpy()
    shipped = tokenised.sparkSession.sparkContext.broadcast((ids, terms.tolist(), matrix))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, known, w = shipped.value
        vocabulary = pa.array(known, pa.string())
        best_s = best_d = None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                size = part.num_rows
                lists = part.column(2)
                row = pc.list_parent_indices(lists).to_numpy()
                term = pc.index_in(pc.list_flatten(lists).cast(pa.string()), vocabulary)
                hit = pc.is_valid(term).to_numpy(zero_copy_only=False)
                term = pc.fill_null(term, 0).to_numpy()[hit].astype(np.int64)
                tf = np.bincount(term * size + row[hit], minlength=len(known) * size)
                tf = tf.reshape(len(known), size).astype(float)
                dl = part.column(1).to_numpy(zero_copy_only=False)
                length = BM25_K1 * (1 - BM25_B + BM25_B * dl / avgdl)
                s = np.round(w @ (tf * (BM25_K1 + 1) / (tf + length[None, :])), 9)
                d = np.broadcast_to(part.column(0).to_numpy(zero_copy_only=False), s.shape)
                if best_s is not None:
                    s, d = np.hstack([best_s, s]), np.hstack([best_d, d])
                best_s, best_d = keep_best(s, d, n)
        if best_s is not None and len(qids):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(qids, best_s.shape[1])),
                    pa.array(best_d.ravel()),
                    pa.array(best_s.ravel()),
                ],
                names=["query_id", "doc_id", "score"],
            )

    docs = tokenised.select(F.col("doc_id").cast("bigint").alias("doc_id"), "dl", "toks")
    return docs.mapInArrow(scan, "query_id bigint, doc_id bigint, score double")


def dense_topk(
    corpus: DataFrame, queries: DataFrame, k: int, doc_id: str = "doc_id", query_id: str = "query_id"
) -> DataFrame:
    """The ``k`` most similar documents per query by cosine, with rank from 1."""
    return nearest(corpus, queries, k, doc_id, query_id)


def reciprocal_rank_fusion(lists: list[DataFrame], k: int = RRF_K) -> DataFrame:
    """Fuse ranked lists (query_id, doc_id, rank from 1): score = Σ 1 / (k + rank)."""
    both = lists[0].select("query_id", "doc_id", "rank")
    for other in lists[1:]:
        both = both.unionByName(other.select("query_id", "doc_id", "rank"))
    return both.groupBy("query_id", "doc_id").agg(
        F.sum(F.lit(1.0) / (F.lit(k) + F.col("rank"))).alias("rrf")
    )


def priority_union(preferred: DataFrame, others: DataFrame) -> DataFrame:
    """Preferred list first, then the others not already in it; ranks renumbered per query.

    Inputs are (query_id, doc_id, rank). Others move back by the number of preferred entries
    and forward by the number of own earlier entries that are dropped.
    """
    size = preferred.groupBy("query_id").agg(F.count("*").alias("_size"))
    kept = others.join(preferred.select("query_id", "doc_id"), ["query_id", "doc_id"], "left_anti")
    w = Window.partitionBy("query_id").orderBy("rank", "doc_id")
    moved = kept.join(size, "query_id", "left").select(
        "query_id",
        "doc_id",
        (F.coalesce("_size", F.lit(0)) + F.row_number().over(w)).cast("bigint").alias("rank"),
    )
    return preferred.select("query_id", "doc_id", F.col("rank").cast("bigint").alias("rank")).unionByName(moved)


def positions(df: DataFrame, group: str, doc_id: str, name: str = "rank") -> DataFrame:
    """1-based position of each document within its group, ordered by an integer id.

    The id range is cut into at most ``RANK_BLOCKS`` blocks; positions are block offset plus
    place within the block, so a group that holds a third of the corpus is still ranked by
    many tasks.
    """
    ids = df.agg(F.struct(F.min(doc_id).alias("lo"), F.max(doc_id).alias("hi"))).scalar()
    span = ids["hi"].cast("double") - ids["lo"]
    width = F.greatest(F.lit(float(RANK_BLOCK)), F.ceil(span / RANK_BLOCKS))
    block = F.floor((F.col(doc_id).cast("double") - ids["lo"]) / width)
    cut = df.withColumn("_block", block)
    sizes = cut.groupBy(group, "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        group, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy(group, "_block").orderBy(doc_id)
    return (
        cut.withColumn("_place", F.row_number().over(inside))
        .join(offsets, [group, "_block"])
        .withColumn(name, (F.col("_offset") + F.col("_place")).cast("bigint"))
        .drop("_block", "_place", "_offset")
    )


def mmr(
    candidates: DataFrame, k: int = 5, weight: float = MMR_LAMBDA
) -> DataFrame:
    """Greedy diverse selection per query: (query_id, doc_id, pick from 1).

    ``candidates`` holds query_id, doc_id, merged_rank, embedding and query_vector, and should
    be a stored table, since each round reads it. A round scores every candidate against the
    picks so far and takes the best per query by one map-side combined aggregation; the next
    round joins those picks, one short row per query. A query with at most ``k`` candidates
    keeps them all in merged order.
    """
    counts = candidates.groupBy("query_id").agg(F.count("*").alias("_n"))
    sized = candidates.join(counts, "query_id")
    few = sized.where(F.col("_n") <= k)
    w = Window.partitionBy("query_id").orderBy("merged_rank", "doc_id")
    whole = few.select("query_id", "doc_id", F.row_number().over(w).alias("pick"))

    many = stored(
        sized.where(F.col("_n") > k)
        .withColumn("relevance", cosine(F.col("query_vector"), F.col("embedding")))
        .select("query_id", "doc_id", "merged_rank", "embedding", "relevance"),
        "mmr-candidates",
    )
    order = F.struct(
        F.col("_s").alias("s"), (-F.col("merged_rank")).alias("r"), (-F.col("doc_id")).alias("d")
    )
    chosen = F.struct("doc_id", "embedding")
    picked = many.withColumn("_s", F.col("relevance")).groupBy("query_id").agg(
        F.array(F.max_by(chosen, order)).alias("picks")
    )
    for _ in range(1, k):
        open_ = many.join(picked, "query_id").where(
            ~F.exists("picks", lambda p: p["doc_id"] == F.col("doc_id"))
        )
        redundancy = F.array_max(
            F.transform("picks", lambda p: cosine(F.col("embedding"), p["embedding"]))
        )
        scored = open_.withColumn("_s", weight * F.col("relevance") - (1 - weight) * redundancy)
        best = scored.groupBy("query_id").agg(
            F.max_by(chosen, order).alias("_next"), F.any_value("picks").alias("picks")
        )
        picked = best.select(
            "query_id", F.concat("picks", F.array("_next")).alias("picks")
        )
    diverse = picked.select("query_id", F.posexplode("picks").alias("pos", "p")).select(
        "query_id", F.col("p.doc_id").alias("doc_id"), (F.col("pos") + 1).alias("pick")
    )
    return whole.unionByName(diverse)


def hybrid_retrieve(
    queries: DataFrame, corpus: DataFrame, namespaces: DataFrame, top_k: int = 5
) -> DataFrame:
    """Routed retrieval: query_id, intent, confidence, route, doc_id, pick.

    ``queries``: query_id, text, embedding. ``corpus``: doc_id (integer), title, content,
    embedding. ``namespaces``: intent, title. Confident queries take their namespace only;
    the others fuse dense and BM25 lists (namespace documents first in the dense list) and
    are diversified. The documents of a large namespace are never paired with its queries:
    they are scanned by ``mmr_scan``.
    """
    first = top_k * 4
    asked = stored(route(classify(queries, "text")), "routed-queries")
    spaces = stored(
        positions(
            corpus.join(namespaces, "title").select("intent", "doc_id"), "intent", "doc_id"
        ),
        "namespace-positions",
    )
    sizes = spaces.groupBy("intent").agg(F.count("*").alias("_space"))
    asked = asked.join(sizes, "intent", "left").withColumn(
        "route", F.when(F.col("_space").isNotNull(), F.col("route")).otherwise("open")
    )

    top = spaces.where(F.col("rank") <= top_k)
    bypass = asked.where(F.col("route") == "bypass").join(top, "intent")
    bypass = bypass.select("query_id", "doc_id", F.col("rank").cast("int").alias("pick"))

    rest = stored(asked.where(F.col("route") != "bypass"), "open-queries")
    dense = dense_topk(corpus, rest, first).select("query_id", "doc_id", "rank")
    words = bm25_topn(tokenise_corpus(corpus, "doc_id", "content"), rest, "query_id", "text", first)
    found = stored(
        dense.withColumn("source", F.lit("dense")).unionByName(
            words.select("query_id", "doc_id", "rank").withColumn("source", F.lit("words"))
        ),
        "found-lists",
    )
    dense = found.where(F.col("source") == "dense").drop("source")
    words = found.where(F.col("source") == "words").drop("source")

    large = (F.col("route") == "blend") & (F.col("_space") > JOINED_SPACE)
    listed, scanned = rest.where(~large), rest.where(large)
    preferred = listed.where(F.col("route") == "blend").join(spaces, "intent").select(
        "query_id", "doc_id", "rank"
    )
    own = listed.select("query_id")
    fused = reciprocal_rank_fusion(
        [
            priority_union(preferred, dense.join(own, "query_id", "left_semi")),
            words.join(own, "query_id", "left_semi"),
        ]
    )
    candidates = (
        fused.withColumn("merged_rank", -F.col("rrf"))
        .join(corpus.select("doc_id", "embedding"), "doc_id")
        .join(listed.select("query_id", F.col("embedding").alias("query_vector")), "query_id")
    )
    chosen = mmr(stored(candidates, "hybrid-candidates"), top_k).unionByName(bypass)
    if not scanned.isEmpty():
        chosen = chosen.unionByName(_scan_large(scanned, corpus, spaces, dense, words, top_k))
    return asked.select("query_id", "intent", "confidence", "route").join(chosen, "query_id")


def _scan_large(
    queries: DataFrame, corpus: DataFrame, spaces: DataFrame, dense: DataFrame, words: DataFrame,
    top_k: int,
) -> DataFrame:
    """Selection for queries of large namespaces, a bounded block of queries at a time."""
    blocks = math.ceil(queries.count() / SCANNED_QUERIES)
    out = None
    for block in range(blocks):
        part = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block)
        out_block = mmr_scan(part, corpus, spaces, dense, words, top_k)
        out = out_block if out is None else out.unionByName(out_block)
    return out


def mmr_scan(
    queries: DataFrame, corpus: DataFrame, spaces: DataFrame, dense: DataFrame, words: DataFrame,
    k: int, weight: float = MMR_LAMBDA,
) -> DataFrame:
    """Greedy diverse selection of a bounded query batch over whole namespaces.

    Candidates of a query are all documents of its namespace plus its own short lists. Each of
    the ``k`` rounds scans the documents once; a task returns its best candidate per query, so
    what is shuffled and collected is one row per query and task, whatever the namespace size.
    Ties go to the better fused score, then the smaller id. Namespaces have more than ``k``
    documents here.
    """
    keys = queries.select("query_id")
    lists = (
        dense.withColumn("kind", F.lit(0)).unionByName(words.withColumn("kind", F.lit(1)))
        .join(keys, "query_id", "left_semi")
    )
    asked = {
        int(r["query_id"]): {
            "intent": r["intent"], "space": int(r["_space"]), "v": _unit(np.array(r["embedding"], float)),
            "dense": [], "words": {}, "picks": [], "vectors": [],
        }
        for r in queries.select("query_id", "intent", "_space", "embedding").collect()
    }
    for r in lists.orderBy("kind", "rank").collect():
        own = asked[int(r["query_id"])]
        if r["kind"] == 0:
            own["dense"].append(int(r["doc_id"]))
        else:
            own["words"][int(r["doc_id"])] = int(r["rank"])
    intents_ = sorted({q["intent"] for q in asked.values()})
    named = spaces.where(F.col("intent").isin(*intents_)).groupBy("doc_id").agg(
        F.collect_list(F.struct("intent", "rank")).alias("spaces")
    )
    docs = stored(
        corpus.select("doc_id", F.col("embedding").cast("array<double>").alias("v"))
        .join(named, "doc_id", "left")
        .join(lists.select("doc_id").distinct().withColumn("listed", F.lit(True)), "doc_id", "left")
        .where(F.col("spaces").isNotNull() | F.col("listed"))
        .select("doc_id", "v", "spaces"),
        "scan-documents",
    )
    # A listed document outside the namespace ranks behind it, in list order.
    members = {
        (int(r["doc_id"]), s["intent"])
        for r in docs.join(lists.select("doc_id").distinct(), "doc_id", "left_semi").collect()
        for s in (r["spaces"] or [])
    }
    for q in asked.values():
        outside = [d for d in q.pop("dense") if (d, q["intent"]) not in members]
        q["rank"] = {d: q["space"] + i + 1 for i, d in enumerate(outside)}

    spark = queries.sparkSession
    for _ in range(k):
        shipped = spark.sparkContext.broadcast(asked)

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            best: dict[int, tuple] = {}
            for pdf in batches:
                if len(pdf) == 0:
                    continue
                ids = pdf["doc_id"].to_numpy()
                unit = _unit(np.vstack(pdf["v"].to_numpy()))
                at = {int(d): i for i, d in enumerate(ids)}
                nowhere = np.full(len(ids), np.inf)
                spots: dict[str, np.ndarray] = {}
                for i, memberships in enumerate(pdf["spaces"]):
                    for m in memberships if memberships is not None else ():
                        spots.setdefault(m["intent"], nowhere.copy())[i] = m["rank"]
                for qid, q in shipped.value.items():
                    place = spots.get(q["intent"], nowhere).copy()
                    for d, r in q["rank"].items():
                        if d in at:
                            place[at[d]] = min(place[at[d]], r)
                    fused = np.where(np.isfinite(place), 1.0 / (RRF_K + place), -1.0)
                    for d, r in q["words"].items():
                        if d in at:
                            fused[at[d]] = max(fused[at[d]], 0.0) + 1.0 / (RRF_K + r)
                    open_ = (fused >= 0) & ~np.isin(ids, q["picks"])
                    if not open_.any():
                        continue
                    s = unit @ q["v"]
                    if q["vectors"]:
                        s = weight * s - (1 - weight) * (unit @ np.array(q["vectors"]).T).max(axis=1)
                    s = np.where(open_, np.round(s, 12), -np.inf)
                    top = np.lexsort((ids, -fused, -s))[0]
                    found = (float(s[top]), float(fused[top]), -int(ids[top]), pdf["v"].iloc[top])
                    if qid not in best or found[:3] > best[qid][:3]:
                        best[qid] = found
            rows = [(qid, -b[2], b[0], b[1], list(b[3])) for qid, b in best.items()]
            yield pd.DataFrame(rows, columns=["query_id", "doc_id", "s", "r", "v"])

        tops = docs.mapInPandas(
            scan, "query_id bigint, doc_id bigint, s double, r double, v array<double>"
        )
        winner = F.max_by(F.struct("doc_id", "v"), F.struct("s", "r", -F.col("doc_id")))
        for r in tops.groupBy("query_id").agg(winner.alias("w")).collect():
            q = asked[int(r["query_id"])]
            q["picks"].append(int(r["w"]["doc_id"]))
            q["vectors"].append(_unit(np.array(r["w"]["v"], float)))
    picked = [(qid, d, i + 1) for qid, q in asked.items() for i, d in enumerate(q["picks"])]
    return spark.createDataFrame(picked, "query_id bigint, doc_id bigint, pick int")


def _unit(v: np.ndarray) -> np.ndarray:
    return v / (np.linalg.norm(v, axis=-1, keepdims=True) + 1e-10)


def assemble_context(
    picks: DataFrame, chunks: DataFrame, live: DataFrame | None = None
) -> DataFrame:
    """Prompt context and source list per query from its few picked chunks."""
    titled = picks.join(chunks.select("doc_id", "title", "content"), "doc_id")
    entry = F.struct(
        F.col("pick").alias("rank"),
        F.col("title"),
        F.concat(F.lit("[Source: "), F.col("title"), F.lit("]\n"), F.col("content")).alias("text"),
    )
    grouped = titled.groupBy("query_id").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    parts = F.transform("e", lambda e: e["text"])
    if live is not None:
        grouped = grouped.join(live.select("query_id", "live_line"), "query_id", "left")
        parts = F.array_compact(F.concat(F.array("live_line"), parts))
    return grouped.select(
        "query_id",
        F.array_join(parts, "\n\n").alias("context"),
        F.transform(
            "e", lambda e: F.struct(e["rank"].alias("rank"), e["title"].alias("namespace"))
        ).alias("sources"),
    )


def corpus_status(chunks: DataFrame, doc: str, title: str) -> DataFrame:
    """Chunk, document and title counts."""
    return chunks.agg(
        F.count("*").alias("chunk_count"),
        F.count_distinct(doc).alias("document_count"),
        F.count_distinct(title).alias("title_count"),
    )
