import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium import session
from tabularium.operators import clean, features, history
from tabularium.sources import readers, registry


def test_csv_na_texts_types_and_encoding(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes("id,name,x\n1,caf\xe9,2.5\n2,NA,nan\n3,,\n".encode("latin-1"))
    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("x", T.DoubleType())]
    )
    rows = readers.read_csv(spark, str(path), schema, encoding="ISO-8859-1").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "café", 2.5), (2, None, None), (3, None, None)]


def test_shape_contract(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    assert readers.require_shape(df, 2, 1) is df
    with pytest.raises(ValueError, match="2930"):
        readers.require_shape(df, 2930, 82)


def test_newest_documents(spark, tmp_path):
    for run, text in (("run-a", "old"), ("run-b", "line one\nline two")):
        (tmp_path / run).mkdir()
        (tmp_path / run / "report.txt").write_text(text)
        (tmp_path / run / "skip.csv").write_text("no")
    rows = readers.read_documents(spark, str(tmp_path)).collect()
    assert [(r["run"], r["title"], r["content"]) for r in rows] == [("run-b", "report", "line one\nline two")]


def test_document_digests_stream_in_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "DIGEST_CHUNK", 5)  # multi-byte characters cross chunk edges
    text = "héllo wörld ✓ 𝄞\nzwei\n" * 7
    for run, body in (("run-a", "old"), ("run-b", text)):
        (tmp_path / run).mkdir()
        (tmp_path / run / "report.txt").write_text(body, encoding="utf-8")
    rows = readers.document_digests(spark, str(tmp_path)).collect()
    want = ("run-b", "report", len(text), hashlib.md5(text.encode()).hexdigest())
    assert [(r["run"], r["title"], r["n_chars"], r["digest"]) for r in rows] == [want]


def test_file_digest(spark, tmp_path):
    (tmp_path / "f.bin").write_bytes(b"abc")
    row = registry.file_digests(spark, str(tmp_path)).first()
    assert row["dataset_hash"] == hashlib.sha256(b"abc").hexdigest() and len(row["dataset_hash"]) == 64


def test_fingerprint_ignores_order(spark):
    df = spark.range(100).select("id", (F.col("id") % 7).alias("k"))
    a, b = registry.fingerprint(df).first(), registry.fingerprint(df.orderBy(F.desc("id")).repartition(7)).first()
    assert a == b
    assert registry.fingerprint(df.where("id > 0")).first() != a


def test_upsert_keeps_older_values(spark):
    base = spark.createDataFrame([(1, 1, "RUNNING", 10), (2, 1, "RUNNING", None)], "k int, v int, status string, n int")
    new = spark.createDataFrame([(1, 2, "SUCCESS", None), (3, 1, None, 5)], base.schema)
    rows = {r["k"]: tuple(r) for r in registry.upsert(base, new, ["k"], "v").collect()}
    assert rows == {1: (1, 2, "SUCCESS", 10), 2: (2, 1, "RUNNING", None), 3: (3, 1, None, 5)}


def test_force_rerun(spark):
    inc = spark.createDataFrame([("h1",), ("h2",)], "dataset_hash string")
    runs = spark.createDataFrame([("h1", "SUCCESS"), ("h1", "SUCCESS"), ("h2", "FAILED")], "dataset_hash string, status string")
    flags = {r[0]: r[1] for r in registry.processed_flag(inc, runs).collect()}
    assert flags == {"h1": True, "h2": False}
    assert registry.processed_flag(inc, runs, force=True).where("is_rerun").count() == 0
    assert [r[0] for r in registry.skip_processed(inc, runs).collect()] == ["h2"]


def test_pages(spark):
    df = spark.range(120).withColumn("severity", F.when(F.col("id") < 5, "HIGH").otherwise("LOW"))
    assert history.page(df, ["id"], 0, 9999).count() == 50
    assert [r[0] for r in history.page(df, ["id"], 3, 50).select("id").collect()] == list(range(100, 120))
    assert history.anomaly_page(df, "high", ["id"]).count() == 5
    assert history.anomaly_page(df, "weird", ["id"]).count() == 50


def test_null_heatmap_falls_back(spark):
    rows = [(1, "a", 0.5), (2, "a", 0.0), (2, "b", 0.0)]
    df = spark.createDataFrame(rows, "run int, column string, null_rate double")
    assert [r["column"] for r in history.null_heatmap(df, "run").collect()] == ["a", "b"]


def test_stored_survives_and_is_sized(spark):
    df = session.stored(spark.range(10).toDF("x"), "t")
    assert df.count() == 10
    plan = spark.range(10**6).toDF("x").join(df, "x")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_shared_dir_needs_setting_off_local(spark, monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_unknown_predicates(spark):
    df = spark.createDataFrame([(1, 5000.0, None), (2, 5000.0, 1.0), (3, None, 1.0)], "id int, a double, p double")
    rule = (F.col("a") > 4000) & (F.col("p") < 200000)
    flags = {r["id"]: r["artifact_flag"] for r in clean.flag_artifacts(df, rule, "r").collect()}
    assert flags == {1: False, 2: True, 3: False}
    assert clean.flag_artifacts(df, rule, "r", remove=True).count() == 2


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "g string, x double, y int")
    train = F.lit(True)
    assert clean.impute_group_median(empty, "x", "g", train).count() == 0
    assert clean.fill_remaining(empty, train).count() == 0
    from tabularium.operators import market, profile

    assert market.market_kpis(empty, "x").first()["transactions"] == 0
    assert profile.schema_confidence(profile.column_profile(empty)).first()["confidence"] == 0.0
    assert sum(r["n"] for r in market.histogram(empty, "x").collect()) == 0


def test_serving_clamps_and_defaults(spark):
    cols = features.FeatureColumns(
        area=("a",), porch=("a",), sold="sold", built="built", remodelled="remod", garage_built="garage",
        full_baths=("a",), half_baths=("a",), presence={"HasPool": "a"}, quality="a", condition="a",
    )
    df = spark.createDataFrame([(1, 2000, 2005, 0, None)], "a int, sold int, built int, remod int, garage int")
    df = df.withColumn("remod", features.default_year("remod", "built"))
    serving = features.engineer(df, cols, clamp=True).first()
    assert (serving["HouseAge"], serving["RemodAge"], serving["GarageAge"]) == (0, 0, 0)
    batch = features.engineer(df, cols).first()
    assert (batch["HouseAge"], batch["GarageAge"]) == (-5, -5)


def test_file_digest_depends_on_bytes_alone(spark, tmp_path):
    """One file in many splits, and the same bytes as one; an empty file has none; a last line without an end."""
    lines = [f"line {k} " + "é" * (k % 50) for k in range(5000)]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "big.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "a" / "cut.txt").write_text("\n".join(lines))
    (tmp_path / "a" / "empty.txt").write_text("")

    def want(text):
        h = [hashlib.sha256(x.encode()).hexdigest() for x in text.split("\n")[: None if text[-1:] != "\n" else -1]] if text else []
        leaves = [hashlib.sha256("".join(h[k : k + 64]).encode()).hexdigest() for k in range(0, len(h), 64)]
        return len(h), hashlib.sha256(f"{len(text.encode())}:{''.join(leaves)}".encode()).hexdigest()

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = []
    for size in (before, "7000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        rows = registry.file_tree_digests(spark, str(tmp_path / "a"), 64).collect()
        found.append({r.path.split("/")[-1]: (r.lines, r.dataset_hash) for r in rows})
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found[0] == found[1] == {n: want((tmp_path / "a" / n).read_text()) for n in ("big.txt", "cut.txt")}
