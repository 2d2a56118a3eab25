"""Text, retrieval and grounding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabularium.functions import text as tx
from tabularium.operators import chunking, conversation, grounding, intents, retrieval
from tabularium.operators.canonical import best_indel, canonicalize
from tabularium.session import new_path, stored
from tabularium.sources.registry import save_table, top_per
from tabularium.vocabulary import (
    HEDGES,
    INTENT_RULES,
    NO_ANSWER,
    NO_CONTEXT,
    STOPWORDS,
)
from workloads.base import query, table

TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"
STOP = "[" + ", ".join(f"'{w}'" for w in STOPWORDS) + "]"
P_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
SPACES = {
    "neighborhood": ["src0", "src1"],
    "model_performance": ["src2", "src3"],
    "data_quality": ["src4", "src5"],
    "anomaly": ["src6"],
    "feature": ["src7", "src8"],
    "temporal": ["src9"],
}


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


@query("tokenize", f"""WITH t AS (SELECT doc_id, {TOKENS} AS toks FROM documents)
SELECT doc_id, len(toks) AS n_tokens, md5(array_to_string(toks, ' ')) AS digest FROM t""")
def tokenize(spark, d):
    toks = table(spark, d, "documents", heavy=True).select("doc_id", tx.tokens(F.col("text")).alias("t"))
    return toks.select(
        "doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("digest")
    )


@query("content_words", f"""WITH t AS (SELECT doc_id, {TOKENS} AS toks FROM documents)
SELECT doc_id, len(list_filter(toks, lambda w: NOT list_contains({STOP}, w))) AS n_content,
  md5(array_to_string(list_filter(toks, lambda w: NOT list_contains({STOP}, w)), ' ')) AS digest FROM t""")
def content_words(spark, d):
    toks = table(spark, d, "documents", heavy=True).select(
        "doc_id", tx.content_tokens(tx.tokens(F.col("text"))).alias("t")
    )
    return toks.select(
        "doc_id", F.size("t").cast("bigint").alias("n_content"), F.md5(F.array_join("t", " ")).alias("digest")
    )


SENTS = r"string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))"


@query("sentence_split", f"""WITH s AS (SELECT doc_id, {SENTS} AS s FROM documents)
SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, md5(s[i]) AS digest
FROM s, unnest(range(1, len(s) + 1)) AS u(i)""")
def sentence_split(spark, d):
    docs = table(spark, d, "documents", heavy=True)
    s = docs.select("doc_id", F.posexplode(tx.sentences(F.col("text"))).alias("pos", "sentence"))
    return s.select("doc_id", "pos", F.md5("sentence").alias("digest"))


@query("strip_markers", """SELECT doc_id, md5(trim(text)) AS digest FROM documents""")
def strip_markers(spark, d):
    docs = table(spark, d, "documents")
    marked = F.concat(
        F.lit("[Source: "), F.col("source"), F.lit("]\n[Live System State]\nDOCUMENT: "),
        F.col("source"), F.lit("\n\n"), F.trim("text"),
    )
    return docs.select("doc_id", F.md5(tx.strip_markers(marked)).alias("digest"))


@query("hedge_flags", "WITH h AS (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN concat(text, ' Perhaps.') "
       "ELSE text END AS text FROM documents) SELECT doc_id, "
       + " OR ".join(f"contains(lower(text), '{p}')" for p in HEDGES) + " AS hedged FROM h")
def hedge_flags(spark, d):
    docs = table(spark, d, "documents").withColumn(
        "text",
        F.when(F.col("doc_id") % 9 == 0, F.concat("text", F.lit(" Perhaps."))).otherwise(F.col("text")),
    )
    return docs.select("doc_id", tx.is_hedged(F.col("text")).alias("hedged"))


WORDS = r"list_filter(regexp_split_to_array({}, '\s+'), lambda w: w <> '')"


@query("window_chunks", f"""WITH w AS (SELECT doc_id, {WORDS.format('text')} AS w FROM documents)
SELECT doc_id, CAST(st // 462 AS INTEGER) AS chunk_index, len(w[st + 1 : st + 512]) AS n_words,
  md5(array_to_string(w[st + 1 : st + 512], ' ')) AS digest
FROM w, unnest(range(0, len(w), 462)) AS u(st)""")
def window_chunks(spark, d):
    c = chunking.window_chunks(table(spark, d, "documents", heavy=True), "doc_id", "text")
    return c.select(
        "doc_id", "chunk_index", F.size(F.split("content", " ")).cast("bigint").alias("n_words"),
        F.md5("content").alias("digest"),
    )


@query("chunk_documents", rf"""WITH RECURSIVE full_text AS (
  SELECT doc_id, concat('DOCUMENT: ', source, chr(10), chr(10), text) AS text FROM documents),
s AS (SELECT doc_id, {SENTS} AS s FROM full_text),
p AS (SELECT doc_id, i AS pos, {WORDS.format('s[i]')} AS w FROM s, unnest(range(1, len(s) + 1)) AS u(i)),
last AS (SELECT doc_id, max(pos) AS n FROM p GROUP BY doc_id),
f AS (
  SELECT doc_id, 0::BIGINT AS pos, []::VARCHAR[] AS cur, NULL::VARCHAR[] AS emitted FROM last
  UNION ALL
  SELECT f.doc_id, p.pos,
    CASE WHEN len(cur) + len(w) > 180 AND len(cur) > 0
      THEN list_concat(cur[greatest(len(cur) - 19, 1) :], w) ELSE list_concat(cur, w) END,
    CASE WHEN len(cur) + len(w) > 180 AND len(cur) > 0 THEN cur END
  FROM f JOIN p ON p.doc_id = f.doc_id AND p.pos = f.pos + 1),
e AS (SELECT doc_id, pos, emitted AS c FROM f WHERE emitted IS NOT NULL
  UNION ALL SELECT f.doc_id, f.pos + 1, cur FROM f JOIN last ON last.doc_id = f.doc_id AND last.n = f.pos
  WHERE len(cur) > 0)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER) AS chunk_index,
  len(c) AS n_words, md5(array_to_string(c, ' ')) AS digest FROM e""")
def chunk_documents(spark, d):
    c = chunking.sentence_chunks(table(spark, d, "documents", heavy=True), "doc_id", "source", "text")
    return c.select(
        "doc_id", "chunk_index", F.size(F.split("content", " ")).cast("bigint").alias("n_words"),
        F.md5("content").alias("digest"),
    )


@query("chunk_table", """WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '') AS w FROM documents)
SELECT source, CAST(sum(CASE WHEN len(w) = 0 THEN 0 ELSE ceil(len(w) / 462.0) END) AS BIGINT) AS chunks
FROM documents JOIN w USING (doc_id) GROUP BY source""")
def chunk_table(spark, d):
    """Chunks per source of a chunk table that was fully refreshed once."""
    docs = table(spark, d, "documents", heavy=True)
    path = new_path(spark, "chunk-table")
    chunks = chunking.window_chunks(docs, "doc_id", "text").drop("content")
    save_table(chunks, path)
    refreshed = save_table(chunks, path)
    per_doc = refreshed.groupBy("doc_id").agg(F.count("*").alias("n"))
    return (
        table(spark, d, "documents").join(per_doc, "doc_id", "left").groupBy("source")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("chunks"))
    )


CLEAN = (r"list_filter(list_transform(string_split(regexp_replace(replace(text, chr(10), ' '), "
         r"'([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '')")


@query("context_budget", rf"""WITH s AS (SELECT doc_id, {CLEAN} AS s FROM documents),
p AS (SELECT doc_id, i AS pos, s[i] AS t, len({WORDS.format('s[i]')}) AS n
  FROM s, unnest(range(1, len(s) + 1)) AS u(i)),
c AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY pos) AS total FROM p),
k AS (SELECT doc_id, count(*) AS kept, md5(string_agg(t, chr(10) ORDER BY pos)) AS digest FROM c
  WHERE total <= 350 GROUP BY doc_id)
SELECT documents.doc_id, coalesce(kept, 0) AS kept, coalesce(digest, md5('')) AS digest
FROM documents LEFT JOIN k ON k.doc_id = documents.doc_id""")
def context_budget(spark, d):
    docs = table(spark, d, "documents", heavy=True).select(
        "doc_id", chunking.context_budget(tx.clean_sentences(F.col("text"))).alias("s")
    )
    return docs.select(
        "doc_id", F.size("s").cast("bigint").alias("kept"), F.md5(F.array_join("s", "\n")).alias("digest")
    )


BM25 = rf"""WITH t AS (SELECT doc_id, {TOKENS} AS toks FROM documents),
st AS (SELECT count(*)::DOUBLE AS n, avg(len(toks)) AS avgdl FROM t),
tf AS (SELECT doc_id, len(toks) AS dl, term, count(*) AS tf FROM t, unnest(toks) AS u(term) GROUP BY ALL),
dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT item_id, term, count(*) AS qtf FROM (SELECT item_id, unnest({TOKENS}) AS term FROM benchmark) GROUP BY ALL),
sc AS (SELECT item_id AS query_id, doc_id, sum(qtf * ln(1 + (n - df + 0.5) / (df + 0.5))
    * (tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * (dl / avgdl))))) AS score
  FROM q JOIN dfq USING (term) JOIN tf USING (term), st GROUP BY item_id, doc_id)
"""


def tokenised(spark, d):
    return retrieval.tokenise_corpus(table(spark, d, "documents", heavy=True), "doc_id", "text")


@query("bm25_scores", BM25 + "SELECT query_id, doc_id, round(score, 6) AS score FROM sc")
def bm25_scores(spark, d):
    out = retrieval.bm25(tokenised(spark, d), table(spark, d, "benchmark"), "item_id", "text")
    return out.withColumn("score", F.round("score", 6))


@query("bm25_topn", BM25 + """, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rk FROM sc WHERE score > 0)
SELECT query_id, doc_id, round(round(score, 9), 6) AS score, CAST(rk AS INTEGER) AS rank FROM r WHERE rk <= 20""")
def bm25_topn(spark, d):
    out = retrieval.bm25_topn(tokenised(spark, d), table(spark, d, "benchmark"), "item_id", "text", 20)
    return out.withColumn("score", F.round("score", 6))


def centroids(spark, d):
    """One query vector per label: the mean of its embeddings."""
    e = table(spark, d, "embeddings")
    long = e.select("label", F.posexplode("embedding").alias("pos", "x"))
    means = long.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    grouped = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("v"))
    return grouped.select(
        F.col("label").cast("bigint").alias("query_id"), F.transform("v", lambda s: s["x"]).alias("embedding")
    )


CENTROIDS = """cen AS (SELECT label, list(x ORDER BY pos) AS v FROM (
    SELECT label, pos, avg(x) AS x FROM (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos
      FROM embeddings) GROUP BY label, pos) GROUP BY label),
ds AS (SELECT cen.label::BIGINT AS query_id, vec_id AS doc_id, list_cosine_similarity(v, embedding::DOUBLE[]) AS score
  FROM cen, embeddings),
dk AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM ds)"""


@query("dense_topk", f"""WITH {CENTROIDS}
SELECT query_id, doc_id, round(round(score, 9), 6) AS score, CAST(rank AS INTEGER) AS rank FROM dk WHERE rank <= 20""")
def dense_topk(spark, d):
    out = retrieval.dense_topk(table(spark, d, "embeddings"), centroids(spark, d), 20, "vec_id")
    return out.select(
        "query_id", F.col("vec_id").alias("doc_id"), F.round("score", 6).alias("score"), "rank"
    )


def ranked_lists(spark, d):
    """Two ranked lists per source: longest documents and smallest document ids."""
    docs = table(spark, d, "documents").select(F.col("source").alias("query_id"), "doc_id", "n_chars")
    longest = top_per(docs, ["query_id"], [F.desc("n_chars"), "doc_id"], 20).drop("n_chars")
    early = top_per(docs, ["query_id"], ["doc_id"], 15).drop("n_chars")
    return longest, early


LISTS = """longest AS (SELECT source AS query_id, doc_id, rank FROM (SELECT source, doc_id,
    row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents) WHERE rank <= 20),
early AS (SELECT source AS query_id, doc_id, rank FROM (SELECT source, doc_id,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank FROM documents) WHERE rank <= 15)"""


@query("rrf_fusion", f"""WITH {LISTS}
SELECT query_id, doc_id, round(sum(1.0 / (60 + rank)), 10) AS rrf
FROM (SELECT * FROM longest UNION ALL SELECT * FROM early) GROUP BY query_id, doc_id""")
def rrf_fusion(spark, d):
    out = retrieval.reciprocal_rank_fusion(list(ranked_lists(spark, d)))
    return out.withColumn("rrf", F.round("rrf", 10))


@query("priority_union", f"""WITH {LISTS}, u AS (
  SELECT query_id, doc_id, rank, 0 AS part FROM early UNION ALL
  SELECT query_id, doc_id, rank, 1 FROM longest l WHERE NOT EXISTS (
    SELECT 1 FROM early e WHERE e.query_id = l.query_id AND e.doc_id = l.doc_id))
SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY part, rank) AS rank FROM u""")
def priority_union(spark, d):
    longest, early = ranked_lists(spark, d)
    return retrieval.priority_union(early, longest)


def _mmr_sql() -> str:
    cos = "list_cosine_similarity(a.v, b.v)"
    steps = ["s1 AS (SELECT query_id, arg_max(doc_id, (rel, -doc_id)) AS doc_id, 1 AS pick FROM c GROUP BY query_id)"]
    chosen = "SELECT * FROM s1"
    for k in range(2, 6):
        steps.append(f"""s{k} AS (SELECT query_id, arg_max(doc_id, (m, -doc_id)) AS doc_id, {k} AS pick FROM (
  SELECT a.query_id, a.doc_id, 0.7 * a.rel - 0.3 * max({cos}) AS m
  FROM c a JOIN ({chosen}) p ON p.query_id = a.query_id JOIN c b ON b.query_id = p.query_id AND b.doc_id = p.doc_id
  WHERE a.doc_id NOT IN (SELECT x.doc_id FROM ({chosen}) x WHERE x.query_id = a.query_id)
  GROUP BY a.query_id, a.doc_id, a.rel) GROUP BY query_id)""")
        chosen += f" UNION ALL SELECT * FROM s{k}"
    return (
        f"WITH {CENTROIDS}, c AS (SELECT query_id, doc_id, score AS rel, e.embedding::DOUBLE[] AS v FROM dk "
        "JOIN embeddings e ON e.vec_id = dk.doc_id WHERE rank <= 20), " + ",\n".join(steps)
        + f"\nSELECT query_id, doc_id, CAST(pick AS INTEGER) AS pick FROM ({chosen})"
    )


@query("mmr_rerank", _mmr_sql())
def mmr_rerank(spark, d):
    cents = centroids(spark, d)
    top = retrieval.dense_topk(table(spark, d, "embeddings"), cents, 20, "vec_id")
    candidates = (
        top.withColumnRenamed("vec_id", "doc_id")
        .join(table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding"), "doc_id")
        .join(cents.select("query_id", F.col("embedding").alias("query_vector")), "query_id")
        .withColumn("merged_rank", F.lit(0))
    )
    return retrieval.mmr(stored(candidates, "mmr-input"), 5)


def corpus(spark, d):
    """Documents that have an embedding, titled by source."""
    docs, e = table(spark, d, "documents", heavy=True), table(spark, d, "embeddings")
    return docs.join(e, docs.doc_id == e.vec_id).select(
        "doc_id", F.col("source").alias("title"), F.col("text").alias("content"), "embedding"
    )


def questions(spark, d):
    """Benchmark texts with the embedding of the same number."""
    b, e = table(spark, d, "benchmark"), table(spark, d, "embeddings")
    return b.join(e, b.item_id == e.vec_id).select(
        F.col("item_id").alias("query_id"), "text", "embedding"
    )


def intent_ctes(keys: str) -> str:
    """CTEs sc … intent that classify the texts ``low`` of CTE ``t`` with the given key columns."""
    parts = []
    for i, (name, (w, words, pats)) in enumerate(INTENT_RULES.items()):
        k = " + ".join(f"contains(low, {quoted(x)})::INT" for x in words)
        p = " + ".join(f"regexp_matches(low, {quoted(x)})::INT" for x in pats)
        parts.append(
            f"SELECT {keys}, {i} AS o, '{name}' AS name, least(({k}) / 2.0::DOUBLE, 1.0) * 0.4::DOUBLE * {w}"
            f" + least(({p})::DOUBLE, 1.0) * 0.6::DOUBLE * {w} AS s FROM t"
        )
    return (
        "sc AS (" + "\nUNION ALL ".join(parts) + "),\n"
        f"rk AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY s DESC, o) AS r FROM sc),\n"
        f"bs AS (SELECT {keys}, max(name) FILTER (r = 1) AS name, max(s) FILTER (r = 1) AS s, max(s) FILTER (r = 2) AS s2 "
        f"FROM rk GROUP BY {keys}),\n"
        f"intent AS (SELECT {keys}, CASE WHEN s = 0 THEN 'general' ELSE name END AS intent, "
        "CASE WHEN s = 0 THEN 0.0 ELSE least(s * (1.0 + greatest(s - s2, 0.0)), 1.0) END AS confidence FROM bs)\n"
    )


def _intent_sql() -> str:
    return (
        "WITH t AS (SELECT conv_id, turn, role, text, lower(CASE WHEN conv_id % 3 = 0 THEN concat('which year had the most home sales? ', text) "
        "WHEN conv_id % 3 = 1 THEN concat('how accurate is the model? ', text) ELSE text END) AS low FROM conversations "
        "WHERE role = 'user'),\n" + intent_ctes("conv_id, turn")
    )


INTENTS = _intent_sql()


def _hybrid_sql() -> str:
    space = "CASE " + " ".join(
        f"WHEN source IN ({', '.join(quoted(x) for x in ts)}) THEN '{i}'" for i, ts in SPACES.items()
    ) + " END"
    cos = "list_cosine_similarity(a.v, b.v)"
    steps = ["s1 AS (SELECT query_id, arg_max(doc_id, (round(rel, 9), rrf, -doc_id)) AS doc_id, 1 AS pick FROM c GROUP BY query_id)"]
    chosen = "SELECT * FROM s1"
    for k in range(2, 6):
        steps.append(f"""s{k} AS (SELECT query_id, arg_max(doc_id, (round(m, 9), rrf, -doc_id)) AS doc_id, {k} AS pick FROM (
  SELECT a.query_id, a.doc_id, a.rrf, 0.7 * a.rel - 0.3 * max({cos}) AS m
  FROM c a JOIN ({chosen}) p ON p.query_id = a.query_id JOIN c b ON b.query_id = p.query_id AND b.doc_id = p.doc_id
  WHERE a.doc_id NOT IN (SELECT x.doc_id FROM ({chosen}) x WHERE x.query_id = a.query_id)
  GROUP BY a.query_id, a.doc_id, a.rel, a.rrf) GROUP BY query_id)""")
        chosen += f" UNION ALL SELECT * FROM s{k}"
    return rf"""WITH t AS (SELECT item_id AS query_id, text, lower(text) AS low, embedding::DOUBLE[] AS v
  FROM benchmark JOIN embeddings ON item_id = vec_id),
{intent_ctes('query_id')},
cp AS (SELECT doc_id, {space} AS intent, text, embedding::DOUBLE[] AS v FROM documents JOIN embeddings ON doc_id = vec_id),
sp AS (SELECT intent, doc_id, row_number() OVER (PARTITION BY intent ORDER BY doc_id) AS rank FROM cp WHERE intent IS NOT NULL),
rt AS (SELECT query_id, intent, confidence, CASE WHEN intent IN (SELECT intent FROM sp) AND confidence >= 0.7 THEN 'bypass'
  WHEN intent IN (SELECT intent FROM sp) AND confidence > 0.3 THEN 'blend' ELSE 'open' END AS route FROM intent),
dn AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY round(list_cosine_similarity(t.v, cp.v), 9) DESC, doc_id) AS rank FROM t, cp),
dk AS (SELECT * FROM dn WHERE rank <= 20),
tk AS (SELECT doc_id, {TOKENS} AS toks FROM cp),
st AS (SELECT count(*)::DOUBLE AS n, avg(len(toks)) AS avgdl FROM tk),
tf AS (SELECT doc_id, len(toks) AS dl, term, count(*) AS tf FROM tk, unnest(toks) AS u(term) GROUP BY ALL),
dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
qt AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT query_id, unnest({TOKENS}) AS term FROM t) GROUP BY ALL),
bm AS (SELECT query_id, doc_id, round(sum(qtf * ln(1 + (n - df + 0.5) / (df + 0.5))
    * (tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * (dl / avgdl))))), 9) AS score
  FROM qt JOIN dfq USING (term) JOIN tf USING (term), st GROUP BY query_id, doc_id),
bk AS (SELECT * FROM (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
  FROM bm WHERE score > 0) WHERE rank <= 20),
pf AS (SELECT query_id, doc_id, rank FROM rt JOIN sp USING (intent) WHERE route = 'blend'),
ls AS (SELECT * FROM pf UNION ALL
  SELECT dk.query_id, dk.doc_id, coalesce((SELECT count(*) FROM pf WHERE pf.query_id = dk.query_id), 0)
    + row_number() OVER (PARTITION BY dk.query_id ORDER BY dk.rank)
  FROM dk WHERE NOT EXISTS (SELECT 1 FROM pf WHERE pf.query_id = dk.query_id AND pf.doc_id = dk.doc_id)),
fu AS (SELECT query_id, doc_id, sum(1.0::DOUBLE / (60 + rank)) AS rrf FROM (SELECT * FROM ls UNION ALL SELECT * FROM bk) GROUP BY ALL),
c AS (SELECT fu.query_id, fu.doc_id, rrf, list_cosine_similarity(t.v, cp.v) AS rel, cp.v FROM fu
  JOIN rt ON rt.query_id = fu.query_id AND route <> 'bypass' JOIN t ON t.query_id = fu.query_id JOIN cp ON cp.doc_id = fu.doc_id),
{", ".join(steps)},
al AS (SELECT query_id, doc_id, pick FROM ({chosen}) UNION ALL
  SELECT query_id, doc_id, rank FROM rt JOIN sp USING (intent) WHERE route = 'bypass' AND rank <= 5)
SELECT rt.query_id, intent, round(confidence, 6) AS confidence, route, doc_id, CAST(pick AS INTEGER) AS pick
FROM al JOIN rt ON rt.query_id = al.query_id"""


@query("hybrid_retrieve", _hybrid_sql())
def hybrid_retrieve(spark, d):
    out = retrieval.hybrid_retrieve(
        questions(spark, d), corpus(spark, d), intents.namespaces(SPACES, spark)
    )
    return out.withColumn("confidence", F.round("confidence", 6))


def asked(spark, d):
    """User messages, two thirds of them opened by a question about the market."""
    users = table(spark, d, "conversations").where(F.col("role") == "user")
    third = F.col("conv_id") % 3
    return users.withColumn(
        "text",
        F.when(third == 0, F.concat(F.lit("which year had the most home sales? "), "text"))
        .when(third == 1, F.concat(F.lit("how accurate is the model? "), "text"))
        .otherwise(F.col("text")),
    )


@query("classify_intent", INTENTS + "SELECT conv_id, turn, intent, round(confidence, 6) AS confidence FROM intent")
def classify_intent(spark, d):
    out = intents.classify(asked(spark, d), "text")
    return out.select("conv_id", "turn", "intent", F.round("confidence", 6).alias("confidence"))


@query("route_query", INTENTS + """SELECT conv_id, turn, CASE WHEN intent <> 'general' AND confidence >= 0.7 THEN 'bypass'
  WHEN intent <> 'general' AND confidence > 0.3 THEN 'blend' ELSE 'open' END AS route FROM intent""")
def route_query(spark, d):
    return intents.route(intents.classify(asked(spark, d), "text")).select("conv_id", "turn", "route")


@query("namespace_filter", "SELECT doc_id, CASE " + " ".join(
    f"WHEN source IN ({', '.join(quoted(t) for t in ts)}) THEN '{i}'" for i, ts in SPACES.items()
) + " END AS intent FROM documents WHERE source IN (" + ", ".join(
    quoted(t) for ts in SPACES.values() for t in ts) + ")")
def namespace_filter(spark, d):
    docs = table(spark, d, "documents").withColumnRenamed("source", "title")
    return intents.namespace_docs(docs, intents.namespaces(SPACES, spark)).select("doc_id", "intent")


@query("live_context", INTENTS + """, m AS (SELECT count(*) AS r, count(*) FILTER (event_type = 'error') AS a,
  floor(max(value)) AS rmse FROM events)
SELECT conv_id, turn, CASE intent
  WHEN 'anomaly' THEN concat('[Live System State]', chr(10), 'The newest run flagged ', a, ' sales as unusual.')
  WHEN 'model_performance' THEN concat('[Live System State]', chr(10), 'Best model so far: R2 0.5, RMSE $', CAST(rmse AS BIGINT), ' on the test rows.')
  WHEN 'feature' THEN concat('[Live System State]', chr(10), 'The newest run read ', r, ' rows and made 12 features.')
  END AS live_line FROM intent, m""")
def live_context(spark, d):
    metrics = table(spark, d, "events").agg(
        F.count("*").alias("rows_processed"),
        F.count_if(F.col("event_type") == "error").alias("anomalies_count"),
        F.floor(F.max("value")).cast("double").alias("best_rmse"),
        F.lit(0.5).alias("best_r2"),
        F.lit(12).alias("features_count"),
    )
    out = intents.live_context(intents.classify(asked(spark, d), "text"), metrics)
    return out.select("conv_id", "turn", "live_line")


@query("citations", """WITH r AS (SELECT source, doc_id, text, row_number() OVER (PARTITION BY source ORDER BY n_chars, doc_id) AS rk FROM documents)
SELECT source AS query_id, md5(string_agg(concat('[Source: ', source, ']', chr(10), text), concat(chr(10), chr(10)) ORDER BY rk)) AS digest,
  string_agg(concat(rk, ':', source), ',' ORDER BY rk) AS sources
FROM r WHERE rk <= 3 GROUP BY source""")
def citations(spark, d):
    docs = table(spark, d, "documents")
    picks = top_per(
        docs.select(F.col("source").alias("query_id"), "doc_id", "n_chars"),
        ["query_id"], ["n_chars", "doc_id"], 3, "pick",
    ).drop("n_chars")
    chunks = docs.select("doc_id", F.col("source").alias("title"), F.col("text").alias("content"))
    out = retrieval.assemble_context(picks, chunks)
    listed = F.transform("sources", lambda s: F.concat_ws(":", s["rank"].cast("string"), s["namespace"]))
    return out.select(
        "query_id", F.md5("context").alias("digest"), F.array_join(listed, ",").alias("sources")
    )


def exchanges(spark, d):
    """Each user message with the next turn as its answer."""
    c = table(spark, d, "conversations", heavy=True)
    asks = c.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    answers = c.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return asks.join(answers, ["conv_id", "turn"])


def _toks(col):
    return TOKENS.replace("text", col)


EXCHANGES = f"""ex AS (SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'),
gr AS (SELECT *, list_filter({_toks('answer')}, lambda w: NOT list_contains({STOP}, w)) AS said,
  list_filter({_toks('question')}, lambda w: NOT list_contains({STOP}, w)) AS known FROM ex),
gs AS (SELECT *, CASE WHEN len(said) = 0 THEN 0.0 ELSE
  len(list_filter(said, lambda w: list_contains(known, w))) / len(said) END AS score FROM gr)"""


@query("grounding_score", f"WITH {EXCHANGES} SELECT conv_id, turn, round(score, 8) AS score FROM gs")
def grounding_score(spark, d):
    score = grounding.grounding_score(F.col("answer"), F.col("question"))
    return exchanges(spark, d).select("conv_id", "turn", F.round(score, 8).alias("score"))


@query("grounding_gate", f"""WITH {EXCHANGES} SELECT conv_id, turn, CASE WHEN score < 0.3 THEN 'extractive'
  WHEN {' OR '.join(f"contains(lower(answer), '{p}')" for p in HEDGES)} THEN 'extractive'
  WHEN score < 0.5 THEN 'needs_review' ELSE 'accept' END AS decision FROM gs""")
def grounding_gate(spark, d):
    ex = exchanges(spark, d).withColumn(
        "score", grounding.grounding_score(F.col("answer"), F.col("question"))
    )
    return ex.select("conv_id", "turn", grounding.gate(F.col("score"), F.col("answer")).alias("decision"))


@query("extractive_answer", rf"""WITH {EXCHANGES}, s AS (
  SELECT conv_id, turn, list_distinct({_toks('question')}) AS q, {CLEAN.replace('text', 'answer')} AS s FROM ex),
p AS (SELECT conv_id, turn, i, s[i] AS t, len(list_filter(q, lambda w: list_contains({_toks('s[i]')}, w))) AS n
  FROM s, unnest(range(1, len(s) + 1)) AS u(i)),
b AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY n DESC, i) AS rk FROM p)
SELECT ex.conv_id, ex.turn, CASE WHEN coalesce(n, 0) >= 2 THEN t ELSE {quoted(NO_ANSWER)} END AS answer
FROM ex LEFT JOIN b ON b.conv_id = ex.conv_id AND b.turn = ex.turn AND rk = 1""")
def extractive_answer(spark, d):
    answer = grounding.extract_by_words(F.col("question"), F.col("answer"))
    return exchanges(spark, d).select("conv_id", "turn", answer.alias("answer"))


@query("refused_answer", rf"""WITH {EXCHANGES}, s AS (
  SELECT conv_id, turn, list_distinct({_toks('question')}) AS q, {CLEAN.replace('text', 'answer')} AS s FROM ex),
p AS (SELECT conv_id, turn, i, s[i] AS t, len(list_filter(q, lambda w: list_contains({_toks('s[i]')}, w))) AS n
  FROM s, unnest(range(1, len(s) + 1)) AS u(i)),
b AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY n DESC, i) AS rk FROM p)
SELECT ex.conv_id, ex.turn, CASE WHEN len(regexp_extract_all(coalesce(ex.answer, ''), '\S+')) < 20 THEN {quoted(NO_CONTEXT)}
  WHEN coalesce(n, 0) >= 2 THEN t ELSE {quoted(NO_ANSWER)} END AS answer
FROM ex LEFT JOIN b ON b.conv_id = ex.conv_id AND b.turn = ex.turn AND rk = 1""")
def refused_answer(spark, d):
    """Every question answered from the text that follows it, refused where that has under 20 words."""
    answer = grounding.answer_or_refuse(F.col("question"), F.col("answer"))
    return exchanges(spark, d).select("conv_id", "turn", answer.alias("answer"))


@query("extractive_by_vector", f"""WITH v AS (SELECT vec_id, vec_id // 8 AS q, vec_id % 8 AS pos, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
p AS (SELECT s.q, s.pos, s.vec_id, list_cosine_similarity(a.e, s.e) AS score FROM v s JOIN v a ON a.q = s.q AND a.pos = 0 WHERE s.pos > 0),
b AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(score, 9) DESC, pos) AS rk FROM p)
SELECT q, round(score, 6) AS score, CASE WHEN score < 0.35 THEN {quoted(NO_ANSWER)} ELSE concat('sentence ', vec_id) END AS answer FROM b WHERE rk = 1""")
def extractive_by_vector(spark, d):
    """Embeddings in runs of eight: the first asks, the others are sentences it is answered by."""
    v = table(spark, d, "embeddings").select(
        "vec_id", F.floor(F.col("vec_id") / 8).alias("q"), (F.col("vec_id") % 8).alias("pos"), F.col("embedding").cast("array<double>").alias("vector")
    )
    asked = v.where("pos = 0").select("q", F.col("vector").alias("question_vector"))
    sentence = F.concat(F.lit("sentence "), F.col("vec_id").cast("string"))
    pairs = v.where("pos > 0").join(asked, "q").withColumn("sentence", sentence)
    return grounding.extract_by_vector(pairs, "q").select("q", F.round("score", 6).alias("score"), "answer")


@query("chat_window", """WITH r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations)
SELECT conv_id, string_agg(concat(CASE WHEN role = 'user' THEN 'User' ELSE 'Assistant' END, ': ', text), chr(10) ORDER BY turn) AS "window"
FROM r WHERE back <= 5 GROUP BY conv_id""")
def chat_window(spark, d):
    return conversation.chat_window(table(spark, d, "conversations"), 5)


@query("chat_turns", """WITH f AS (SELECT * FROM conversations WHERE role <> 'system'),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM f),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM r WHERE back <= 10),
p AS (SELECT u.conv_id, u.i, concat('[Turn ', (u.i + 1) // 2, '] User: ', u.text, chr(10), 'Assistant: ', a.text) AS t
  FROM n u JOIN n a ON a.conv_id = u.conv_id AND a.i = u.i + 1 WHERE u.i % 2 = 1)
SELECT c.conv_id, coalesce(string_agg(p.t, chr(10) ORDER BY p.i), '') AS turns
FROM (SELECT DISTINCT conv_id FROM f) c LEFT JOIN p ON p.conv_id = c.conv_id GROUP BY c.conv_id""")
def chat_turns(spark, d):
    messages = table(spark, d, "conversations").where(F.col("role") != "system")
    return conversation.chat_turns(messages, 5)


@query("corpus_status", """SELECT count(*) AS chunk_count, count(DISTINCT doc_id) AS document_count,
  count(DISTINCT source) AS title_count FROM documents""")
def corpus_status(spark, d):
    return retrieval.corpus_status(table(spark, d, "documents"), "doc_id", "source")


MISSPELLED = "CASE WHEN p_partkey % 13 = 0 THEN left(p_type, length(p_type) - 1) ELSE p_type END"


def misspelled(spark, d):
    part = table(spark, d, "part")
    cut = F.expr("left(p_type, length(p_type) - 1)")
    return part.select(
        "p_partkey", F.when(F.col("p_partkey") % 13 == 0, cut).otherwise(F.col("p_type")).alias("value")
    )


@query("canonicalize_values", f"""WITH m AS (SELECT p_partkey, {MISSPELLED} AS value FROM part),
v AS (SELECT unnest({P_TYPES}) AS name),
s AS (SELECT value, name, (1 - levenshtein(value, name) / greatest(length(value), length(name))::DOUBLE) * 100 AS score
  FROM (SELECT DISTINCT value FROM m), v),
b AS (SELECT value, arg_max(name, score) AS name, max(score) AS score FROM s GROUP BY value)
SELECT p_partkey, m.value, CASE WHEN score > 80 THEN name ELSE m.value END AS canonical FROM m JOIN b USING (value)""")
def canonicalize_values(spark, d):
    return canonicalize(misspelled(spark, d), "value", P_TYPES)


@query("fuzzy_indel", f"""WITH RECURSIVE m AS (SELECT p_partkey, {MISSPELLED} AS value FROM part),
v AS (SELECT unnest({P_TYPES}) AS name, unnest(range({len(P_TYPES)})) AS ord),
d AS (
  SELECT value, name, ord, 0 AS i, list_transform(range(0, length(name) + 1), lambda x: 0) AS lcs
  FROM (SELECT DISTINCT value FROM m), v
  UNION ALL
  SELECT value, name, ord, i + 1, list_concat([0], list_transform(range(1, length(name) + 1), lambda j:
    greatest(lcs[j + 1], list_max(list_transform(range(1, j + 1), lambda k:
      CASE WHEN substr(name, k, 1) = substr(value, i + 1, 1) THEN lcs[k] + 1 ELSE 0 END)))))
  FROM d WHERE i < length(value)),
s AS (SELECT value, name, ord, 200.0::DOUBLE * lcs[len(lcs)] / (length(value) + length(name)) AS score
  FROM d WHERE i = length(value)),
b AS (SELECT value, arg_max(name, (score, -ord)) AS name, max(score) AS score FROM s GROUP BY value)
SELECT p_partkey, m.value, CASE WHEN score > 80 THEN name ELSE m.value END AS canonical FROM m JOIN b USING (value)""")
def fuzzy_indel(spark, d):
    return canonicalize(misspelled(spark, d), "value", P_TYPES, best_indel)
