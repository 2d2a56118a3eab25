"""The registered queries of the subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL statement where one exists."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    from tabularium.llm.quality import quality_rules

    return quality_rules(table(spark, folder, "documents"))


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from tabularium.llm import toxicity

    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit_labelled(docs, table(spark, folder, "labels")))


@query(
    "op8_warc",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    g AS (SELECT html, min(page_id) AS first_id FROM p GROUP BY html),
    b AS (SELECT page_id, strlen(html) AS n, first_id,
                 list_transform(range(160), lambda i: (ascii(upper(substr(sha1(html), CAST(i // 4 + 1 AS BIGINT), 1)))
                   - CASE WHEN upper(substr(sha1(html), CAST(i // 4 + 1 AS BIGINT), 1)) >= 'A' THEN 55 ELSE 48 END)
                   >> (3 - i % 4) & 1) AS bits
          FROM p JOIN g USING (html))
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
           array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             CAST(16 * bits[5 * i + 1] + 8 * bits[5 * i + 2] + 4 * bits[5 * i + 3] + 2 * bits[5 * i + 4] + bits[5 * i + 5] + 1 AS BIGINT), 1)), '') AS payload_digest,
           CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first_id THEN first_id END AS refers_to
    FROM b
    """,
)
def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    from tabularium.llm.warc import archive

    return archive(table(spark, folder, "pages")).drop("url", "offset", "length")


def conversations_as_tools(chat: DataFrame) -> DataFrame:
    """The conversations as tool use: each user turn calls a tool that the next turn answers.

    The call names the tool by the length of the question, passes the question and its words,
    and comes after the calls of the two turns before it; some lack a field their tool requires.
    """
    from pyspark.sql import functions as F

    key = lambda shift: F.format_string("call-%d", F.col("turn") - shift)
    text = F.coalesce("text", F.lit(""))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    given = F.struct(text.alias("question"), F.when(words % 5 != 0, words).alias("words"))
    after = F.array(key(2), key(1))
    name = F.when(F.length(text) < 200, "lookup").when(F.length(text) < 800, "search").otherwise("archive")
    call = F.to_json(F.struct(key(0).alias("id"), name.alias("name"), given.alias("arguments"), after.alias("after")))
    answer = F.to_json(F.struct(key(1).alias("call_id"), text.alias("content")))
    asked = chat.where("role = 'user'").select("conv_id", "turn", F.lit("assistant").alias("role"), call.alias("text"))
    told = chat.where("role = 'assistant'").select("conv_id", "turn", F.lit("tool").alias("role"), answer.alias("text"))
    return asked.unionByName(told)


TOOLS = {
    name: {"required": ["question", "words"], "properties": {"question": {"type": "string"}, "words": {"type": "integer"}}}
    for name in ("lookup", "search")
}


@query("op9_chat_tools")
def op9_chat_tools(spark: SparkSession, folder: str) -> DataFrame:
    from tabularium.llm.chat import link_calls

    return link_calls(conversations_as_tools(table(spark, folder, "conversations")), TOOLS)


@query("op10_packing")
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    from tabularium.llm.packing import pack

    return pack(table(spark, folder, "documents"))


SHINGLES = """
    w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    sh AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))
                                               WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
    pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
    reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
"""


@query(
    "op6_ngram_jaccard",
    f"""WITH RECURSIVE {SHINGLES}
    SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce((SELECT min(b) FROM reach WHERE a = w.doc_id), w.doc_id)) AS component_id
    FROM w LEFT JOIN n USING (doc_id)""",
)
def op6_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    from tabularium.llm.jaccard import link_documents

    return link_documents(table(spark, folder, "documents")).drop("class_id", "n_copies")


@query(
    "op3_repeated_passages",
    """
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    p AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM w WHERE len(w) >= 13),
    win AS (SELECT doc_id, i, array_to_string(w[i:i+12], ' ') AS s FROM p),
    own AS (SELECT s, min(doc_id) AS o FROM win GROUP BY s),
    cov AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM win JOIN own USING (s) WHERE o < doc_id),
    one AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM w),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS t, count(*) AS n FROM one ANTI JOIN cov USING (doc_id, k) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id)
    """,
)
def op3_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    from tabularium.llm.substrings import remove_repeats

    return remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))


@query("op2_decontamination")
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    from tabularium.llm.decontaminate import find_leaks

    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op1_token_segments")
def op1_token_segments(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from tabularium.llm.tokens import round_trip

    return round_trip(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op4_main_text")
def op4_main_text(spark: SparkSession, folder: str) -> DataFrame:
    from tabularium.llm.html import extract_main

    return extract_main(table(spark, folder, "pages"))


@query("op11_token_counts")
def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from tabularium.llm.token_counts import count_tokens

    return count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query(
    "op12_collocations",
    """
    WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
    pos AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k)),
    f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a FROM pos GROUP BY ALL),
    n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
    c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, a FROM f WHERE k > 1 AND a >= 100),
    cut AS (SELECT lang, phrase, a, w, unnest(range(1, k)) AS j, k FROM c),
    s AS (SELECT cut.lang, cut.phrase, cut.a, j, x.a AS l, y.a AS r, n.n,
                 CAST(CAST(1000 AS HUGEINT) * cut.a * n.n // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
          FROM cut JOIN n ON n.lang = cut.lang
          JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(cut.w[1:j], ' ')
          JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(cut.w[j + 1:], ' ')),
    m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
    inner_ AS (SELECT lang, array_to_string(w[i:i + v - 1], ' ') AS phrase, max(a) AS longer
               FROM (SELECT lang, w, k, a, unnest(range(2, k)) AS v FROM c), unnest(range(1, k - v + 2)) AS u(i) GROUP BY ALL),
    kept AS (SELECT m.* FROM m LEFT JOIN inner_ USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a)
    SELECT lang, rank, phrase, a, l, r, n, score
    FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000
    """,
)
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    from tabularium.llm.collocations import collocations

    return collocations(table(spark, folder, "documents"))


@query(
    "op13_prefix_trie",
    """
    WITH own AS (SELECT conv_id AS c, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS turns
                 FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    b AS (SELECT *, [4294967295] || flatten(list_transform(range(1, length(CAST(c AS VARCHAR)) + 1),
                 lambda i: [CAST(ascii(substr(CAST(c AS VARCHAR), i, 1)) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])) AS steps FROM own),
    h AS (SELECT c, turns, xor(list_reduce(steps, lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) ELSE xor(s >> 1, 3988292384 * (s & 1)) END),
                 4294967295) % 6 AS h FROM b),
    built AS (SELECT h.c, coalesce(base.turns[1:h.h], []) || coalesce(h.turns[h.h + 1:], []) AS path
              FROM h LEFT JOIN own base ON base.c = h.c - h.c % 100),
    m AS (SELECT c, path[1:d] AS p, d, d = len(path) AS ends FROM (SELECT c, path, unnest(range(len(path) + 1)) AS d FROM built)),
    node AS (SELECT p, d, min(c) AS conv_id, count(*) AS n, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '') AS ids
             FROM m GROUP BY p, d),
    kid AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
    share AS (SELECT node.p, node.d, CASE WHEN node.d = 0 THEN 0 ELSE (n - 1) * length(node.p[node.d].t) END AS v,
                     CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf
              FROM node LEFT JOIN kid USING (p, d)),
    up AS (SELECT p[1:k] AS p, k AS d, CAST(sum(v) AS BIGINT) AS saved, CAST(sum(leaf) AS BIGINT) AS leaves
           FROM (SELECT p, v, leaf, unnest(range(d + 1)) AS k FROM share) GROUP BY ALL)
    SELECT node.conv_id, node.d AS depth, parent.conv_id AS parent_conv_id, node.n AS n_convs, coalesce(n_children, 0) AS n_children,
           leaves AS n_leaves, saved AS saved_tokens, sha256(node.ids) AS ends_sha256
    FROM node JOIN up USING (p, d) LEFT JOIN kid USING (p, d) LEFT JOIN node parent ON parent.d = node.d - 1 AND parent.p = node.p[1:node.d - 1]
    """,
)
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    from tabularium.llm.prefixes import prefix_trie

    return prefix_trie(table(spark, folder, "conversations"))
