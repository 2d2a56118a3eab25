import zlib

from tabularium.llm import queries, toxicity


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    rows = queries.QUERIES["op7_toxicity"](spark, folder)
    held = rows.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    positive = sorted(r.score for r in held if r.toxic == 1)
    negative = [r.score for r in held if r.toxic == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in positive for b in negative)
    assert wins / len(positive) / len(negative) > 0.8
    assert sum(r.predicted == r.toxic for r in held) / len(held) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in held)
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == r.held_out for r in held)


def test_nulls_empty_and_repeats(spark):
    text = "fine words about the weather in the town today " * 12
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", "y"), (2, "", "y"), (None, text, "z"), (3, "bad " * 4000, "w")],
        "doc_id long, text string, score string",
    )
    labels = spark.createDataFrame([(1, 1, None), (2, 0, 1), (None, 0, 1)], "doc_id long, quality int, toxic int")
    rows = toxicity.score(docs, toxicity.fit_labelled(docs, labels)).collect()
    assert len(rows) == 5 and len({r.score for r in rows}) == 1
    empty = docs.limit(0)
    assert toxicity.score(empty, toxicity.fit_labelled(empty, labels)).count() == 0


def test_stems_come_from_many_contexts():
    import random

    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    def prose(*extra):
        return " ".join(rng.choice(vocabulary) if rng.random() > 0.05 or not extra else rng.choice(extra) for _ in range(200))
    ordinary = [prose() for _ in range(120)]
    toxic = [prose("zorgful", "zorgness", "zorgish") for _ in range(60)]
    plain, marked = toxicity.train_dictionaries(toxic, ordinary)
    assert len(plain) == len(marked) and b" zorg" in marked and b" zorg" not in plain
    model = toxicity.fit(toxic[:30], ordinary[:60], [(t, 1) for t in toxic[30:]] + [(t, 0) for t in ordinary[60:]])
    assert len(model.weights) == len(model.mean) + 1 and model.weights[1:].any()


def _text_reads(node):
    """The plan strings of the nodes right above every leaf whose rows carry a text column."""
    found = []
    for i in range(node.children().size()):
        child = node.children().apply(i)
        output = child.output()
        if child.children().size() == 0 and any(output.apply(k).name() == "text" for k in range(output.size())):
            found.append(node.toString().split("\n")[0])
        found += _text_reads(child)
    return found


def test_sample_is_the_first_rows_and_shuffles_no_other_text(spark):
    import re

    from pyspark.sql import functions as F

    docs = spark.createDataFrame(
        [(i % 19000, f"text {i % 7} of {i}", "s") for i in range(20000)] + [(5, None, "s")],
        "doc_id long, text string, score string",
    )
    labels = spark.createDataFrame([(i, 0, int(i % 4 == 0)) for i in range(19000)], "doc_id long, quality int, toxic int")
    sample = toxicity.labelled_sample(docs, labels)

    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    known = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(fold != 0)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(known, "doc_id")
    rows = rows.select(fold.alias("fold"), F.xxhash64("doc_id").alias("rank"), "text", "toxic")
    want = rows.where("fold > 2").orderBy("rank", "text").limit(5000).select(F.lit("calibration").alias("part"), "text", "toxic")
    for label, n in ((1, 1200), (0, 2000)):
        part = rows.where(F.col("fold").isin(1, 2) & (F.col("toxic") == label)).orderBy("rank", "text").limit(n)
        want = want.union(part.select(F.lit("dictionary").alias("part"), "text", "toxic"))
    assert sorted(sample.collect()) == sorted(want.collect())

    # Texts are read only through the cut on the hash of the id, below any join or shuffle.
    reads = _text_reads(sample._jdf.queryExecution().sparkPlan())
    assert len(reads) == 3 and all(re.search(r"^Filter .*xxhash64\([^)]*\) <= ", p) for p in reads)
