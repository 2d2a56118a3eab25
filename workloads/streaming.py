"""Event monitoring and run-history queries; most run as Structured Streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.operators import history as h
from tabularium.session import new_path
from tabularium.sources.merge import merge_stream
from tabularium.sources.readers import event_stream
from tabularium.sources.registry import latest_complete_run, latest_per, upsert
from tabularium.streaming import monitor, stateful
from tabularium.vocabulary import DURATION_BOUNDS, FINAL_STAGE, STAGES
from workloads.base import query, table

SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def as_run_events(df):
    """Events as pipeline events: run, stage and status."""
    stages = F.array(*[F.lit(s) for s in STAGES])
    return df.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").alias("run_id"),
        F.element_at(stages, (F.col("event_id") % 8 + 1).cast("int")).alias("stage"),
        F.when(F.col("event_type") == "error", "FAILED")
        .when(F.col("event_type") == "purchase", "SUCCESS")
        .otherwise("PROGRESS")
        .alias("status"),
        "event_type",
        "value",
    )


def stream(spark, d):
    return as_run_events(event_stream(spark, d, "events.parquet", SCHEMA))


def batch(spark, d):
    return as_run_events(table(spark, d, "events"))


EV = """ev AS (SELECT event_id, ts, user_id AS run_id, ['""" + "','".join(STAGES) + """'][event_id % 8 + 1] AS stage,
  CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'SUCCESS' ELSE 'PROGRESS' END AS status,
  event_type, value FROM events)"""


@query("stream_scan", f"WITH {EV} SELECT event_id, ts, run_id, status, value FROM ev")
def stream_scan(spark, d):
    s = stream(spark, d).select("event_id", "ts", "run_id", "status", "value")
    return monitor.append_all(s, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("events_daily", f"""WITH {EV} SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type, status, count(*) AS n
FROM ev GROUP BY ALL""")
def events_daily(spark, d):
    keys = ["window_start", "event_type", "status"]
    out = monitor.drain(monitor.window_counts(stream(spark, d), keys[1:]), keys, "daily")
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("error_rate_sliding", f"""WITH {EV}, w AS (
  SELECT time_bucket(INTERVAL 1 MINUTE, ts) - INTERVAL (k) MINUTE AS window_start FROM ev, unnest(range(5)) AS u(k)
  WHERE status = 'FAILED')
SELECT window_start, round(count(*) / 300.0::DOUBLE, 10) AS per_second FROM w GROUP BY window_start""")
def error_rate_sliding(spark, d):
    failures = stream(spark, d).where(F.col("status") == "FAILED")
    out = monitor.drain(monitor.sliding_rate(failures, []), ["window_start"], "rates")
    return out.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.round("per_second", 10).alias("per_second"),
    )


def _quantile_sql(q: float) -> str:
    out = "300.0::DOUBLE"
    for i in range(len(DURATION_BOUNDS) - 1, -1, -1):
        lo = DURATION_BOUNDS[i - 1] if i else 0
        below = f"b{i - 1}" if i else "0"
        out = (f"CASE WHEN b{i} >= {q} * total THEN {lo} + ({DURATION_BOUNDS[i]} - {lo})::DOUBLE * "
               f"({q} * total - {below}) / nullif(b{i} - {below}, 0) ELSE {out} END")
    return out


@query("histogram_quantile", f"""WITH {EV}, b AS (SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type,
  {', '.join(f'count(*) FILTER (value <= {b}) AS b{i}' for i, b in enumerate(DURATION_BOUNDS))},
  count(value) AS total FROM ev GROUP BY ALL)
SELECT window_start, event_type, round({_quantile_sql(0.5)}, 8) AS p50, round({_quantile_sql(0.95)}, 8) AS p95 FROM b""")
def histogram_quantile(spark, d):
    q = monitor.histogram_quantiles(stream(spark, d), ["event_type"], "value", DURATION_BOUNDS)
    out = monitor.drain(q, ["window_start", "event_type"], "quantiles")
    return out.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type",
        F.round("p50", 8).alias("p50"), F.round("p95", 8).alias("p95"),
    )


LATEST = f"""{EV}, ls AS (SELECT run_id, stage, arg_max(status, (ts, event_id)) AS status FROM ev GROUP BY run_id, stage)"""


@query("latest_status", f"WITH {LATEST} SELECT run_id, stage, status FROM ls")
def latest_status(spark, d):
    return monitor.latest_status(batch(spark, d))


@query("run_progress", f"""WITH {LATEST} SELECT run_id,
  count(*) FILTER (status IN ('SUCCESS', 'FAILED')) * 100.0::DOUBLE / 8 AS progress_pct FROM ls GROUP BY run_id""")
def run_progress(spark, d):
    statuses = monitor.drain(monitor.latest_status(stream(spark, d)), ["run_id", "stage"], "status")
    return monitor.progress(statuses)


@query("run_completion", f"""WITH {EV}, f AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ts, event_id) AS rk
  FROM ev WHERE stage = '{FINAL_STAGE}' AND status IN ('SUCCESS', 'FAILED'))
SELECT run_id, status, ts AS completed_at, event_id FROM f WHERE rk = 1""")
def run_completion(spark, d):
    out = stateful.completions(stream(spark, d))
    return out.withColumn("completed_at", F.col("completed_at").cast("timestamp_ntz"))


@query("run_endings", f"""WITH {EV}, e AS (SELECT run_id, epoch_us(ts) AS us, event_id,
  CASE WHEN stage = '{FINAL_STAGE}' AND status IN ('SUCCESS', 'FAILED') THEN status END AS final FROM ev),
p AS (SELECT max(us) // 1000 * 1000 - {stateful.LATENESS_S * 1_000_000} AS passed FROM e),
b AS (SELECT e.*, CASE WHEN us - lag(us) OVER (PARTITION BY run_id ORDER BY us, event_id) > {stateful.SILENCE_S * 1_000_000} THEN 1 ELSE 0 END AS broken
  FROM e, p WHERE us < passed),
s AS (SELECT *, sum(broken) OVER (PARTITION BY run_id ORDER BY us, event_id) AS part FROM b),
n AS (SELECT *, row_number() OVER (PARTITION BY run_id, part ORDER BY us, event_id) AS n FROM s),
r AS (SELECT run_id, part, min(us) AS started, max(us) + {stateful.SILENCE_S * 1_000_000} AS until, max((us, event_id, n, '')) AS last,
  min((us, event_id, n, final)) FILTER (final IS NOT NULL) AS done FROM n GROUP BY ALL)
SELECT run_id, make_timestamp(started) AS started_at, make_timestamp(CASE WHEN done IS NULL THEN until ELSE done[1] END) AS ended_at,
  coalesce(done[4], 'TIMEOUT') AS status, CASE WHEN done IS NULL THEN last[2] ELSE done[2] END AS event_id,
  CASE WHEN done IS NULL THEN last[3] ELSE done[3] END AS n_events
FROM r, p WHERE done IS NOT NULL OR until < passed""")
def run_endings(spark, d):
    """How every run ended: in its final stage or by a day of silence."""
    out = monitor.append_all(stateful.endings(stream(spark, d)), "endings")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("started_at", "ended_at")})


@query("bounded_history", f"""WITH {EV}, fr AS (SELECT run_id FROM ev GROUP BY run_id ORDER BY min((ts, event_id)) DESC LIMIT 50),
r AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ts DESC, event_id DESC) AS back FROM ev)
SELECT run_id, event_id, stage, status FROM r WHERE back <= 20 AND run_id IN (SELECT run_id FROM fr)""")
def bounded_history(spark, d):
    kept = stateful.batch_histories(batch(spark, d), 20, 50)
    return kept.select("run_id", "event_id", "stage", "status")


@query("bounded_history_stream", f"""WITH {EV}, r AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ts DESC, event_id DESC) AS back FROM ev)
SELECT run_id, event_id FROM r WHERE back <= 20""")
def bounded_history_stream(spark, d):
    return stateful.histories(stream(spark, d), 20).select("run_id", "event_id")


@query("metric_gauges", f"""WITH {EV} SELECT event_type, status, count(*) AS total,
  arg_max(value, (ts, event_id)) AS last_value FROM ev GROUP BY event_type, status""")
def metric_gauges(spark, d):
    g = monitor.gauges(stream(spark, d), ["event_type", "status"], "value")
    return monitor.drain(g, ["event_type", "status"], "gauges")


@query("failure_ratio", f"""WITH {EV}, f AS (SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, stage,
  count(*) FILTER (status = 'SUCCESS') AS successes, count(*) FILTER (status = 'FAILED') AS failures FROM ev GROUP BY ALL)
SELECT *, round(coalesce(failures / nullif(successes + failures, 0), 0.0), 8) AS failure_ratio FROM f""")
def failure_ratio(spark, d):
    out = monitor.drain(monitor.failure_ratio(stream(spark, d), ["stage"]), ["window_start", "stage"], "failures")
    return out.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "stage", "successes",
        "failures", F.round("failure_ratio", 8).alias("failure_ratio"),
    )


UPSERTED = f"""{EV}, u AS (SELECT run_id, max(event_id) AS event_id, arg_max(status, event_id) AS status,
  arg_max(value, event_id) FILTER (status <> 'FAILED') AS value FROM ev GROUP BY run_id)"""


def states(events):
    """Run-state rows; failures carry no value."""
    value = F.when(F.col("status") != "FAILED", F.col("value"))
    return events.select("run_id", "event_id", "status", value.alias("value"))


@query("upsert_latest", f"WITH {UPSERTED} SELECT run_id, event_id, status, value FROM u")
def upsert_latest(spark, d):
    s = states(batch(spark, d))
    early = F.col("status") == "PROGRESS"
    return upsert(s.where(early), s.where(~early), ["run_id"], "event_id")


@query("stream_upsert", f"WITH {UPSERTED} SELECT run_id, event_id, status, value FROM u")
def stream_upsert(spark, d):
    """Every micro-batch is merged into the buckets of the run-state table that its runs fall into."""
    root, keys = new_path(spark, "run-state"), ["run_id"]
    return merge_stream(
        states(stream(spark, d)), keys, lambda base, rows: upsert(base, rows, keys, "event_id"), root, f"{root}-checkpoint"
    )


# Run history, derived from the events: one run per user and day.


def runs(spark, d):
    ev = batch(spark, d).withColumn("day", F.date_format("ts", "yyyyMMdd"))
    run_id = F.concat_ws("-", F.col("run_id").cast("string"), "day")
    return (
        ev.groupBy(run_id.alias("run_id"), F.col("run_id").alias("owner"))
        .agg(
            F.min("ts").alias("started_at"),
            F.max("ts").alias("completed_at"),
            F.count("*").alias("rows_out"),
            F.max_by("status", F.struct("ts", "event_id")).alias("last"),
            F.count_if(F.col("event_type") == "view").alias("views"),
            F.count_if(F.col("event_type") == "click").alias("clicks"),
        )
        .withColumn("status", F.when(F.col("last") == "FAILED", "FAILED").otherwise("SUCCESS"))
    )


RUNS = f"""{EV}, runs AS (SELECT concat_ws('-', run_id, strftime(ts, '%Y%m%d')) AS run_id, run_id AS owner,
  min(ts) AS started_at, max(ts) AS completed_at, count(*) AS rows_out,
  CASE WHEN arg_max(status, (ts, event_id)) = 'FAILED' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'click') AS clicks
  FROM ev GROUP BY 1, 2)"""


@query("run_history", f"""WITH {RUNS}, t AS (SELECT run_id, owner, status, (epoch_us(completed_at) - epoch_us(started_at)) // 1000 AS duration_ms,
  started_at FROM runs)
SELECT run_id, status, duration_ms, duration_ms - lag(duration_ms) OVER (PARTITION BY owner ORDER BY started_at, run_id) AS delta_ms FROM t""")
def run_history(spark, d):
    return h.run_history(runs(spark, d)).select("run_id", "status", "duration_ms", "delta_ms")


@query("latest_run", f"""WITH {RUNS} SELECT run_id, status, rows_out FROM runs WHERE views > 0 AND clicks > 0
ORDER BY run_id DESC LIMIT 1""")
def latest_run(spark, d):
    r = runs(spark, d).select(
        "run_id", "status", "rows_out",
        (F.col("views") > 0).alias("has_model"), (F.col("clicks") > 0).alias("has_features"),
    )
    return latest_complete_run(r, ["has_model", "has_features"]).select("run_id", "status", "rows_out")


def tagged(spark, d):
    ev = batch(spark, d)
    return ev.withColumn(
        "run_id", F.concat_ws("-", F.col("run_id").cast("string"), F.date_format("ts", "yyyyMMdd"))
    )


@query("latest_metrics", f"""WITH {RUNS}, tg AS (SELECT *, concat_ws('-', run_id, strftime(ts, '%Y%m%d')) AS rid FROM ev),
n AS (SELECT run_id, rows_out FROM runs WHERE status = 'SUCCESS' ORDER BY started_at DESC, run_id DESC LIMIT 1),
md AS (SELECT rid, min(value) AS test_rmse FROM tg WHERE status = 'SUCCESS' GROUP BY rid),
an AS (SELECT rid, count(*) AS c FROM tg WHERE status = 'FAILED' GROUP BY rid)
SELECT n.run_id, rows_out AS rows_processed, coalesce(c, 0) AS anomalies_count, coalesce(test_rmse, 0.0) AS best_rmse,
  round(coalesce(1 - test_rmse / 1000, 0.0), 8) AS best_r2
FROM n LEFT JOIN md ON md.rid = n.run_id LEFT JOIN an ON an.rid = n.run_id""")
def latest_metrics(spark, d):
    ev = tagged(spark, d)
    models = ev.where(F.col("status") == "SUCCESS").groupBy("run_id").agg(F.min("value").alias("test_rmse"))
    models = models.withColumn("test_r2", 1 - F.col("test_rmse") / 1000).withColumn("is_best", F.lit(True))
    anomalies = ev.where(F.col("status") == "FAILED").select("run_id")
    out = h.latest_metrics(runs(spark, d), models, anomalies)
    return out.withColumn("best_r2", F.round("best_r2", 8))


@query("anomaly_page", """SELECT event_id, severity FROM (SELECT event_id, ts, CASE WHEN value > 50 THEN 'HIGH'
  WHEN value > 10 THEN 'MEDIUM' ELSE 'LOW' END AS severity FROM events WHERE event_type = 'error')
WHERE severity = 'HIGH' ORDER BY ts DESC, event_id LIMIT 10 OFFSET 10""")
def anomaly_page(spark, d):
    log = table(spark, d, "events").where(F.col("event_type") == "error").select(
        "event_id", "ts",
        F.when(F.col("value") > 50, "HIGH").when(F.col("value") > 10, "MEDIUM").otherwise("LOW").alias("severity"),
    )
    return h.anomaly_page(log, "high", [F.desc("ts"), "event_id"], 2, 10).select("event_id", "severity")


@query("anomaly_record", """SELECT event_id, ts, value, CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) AS k FROM events
WHERE event_id = (SELECT max(event_id) FROM events WHERE event_type = 'error')""")
def anomaly_record(spark, d):
    """The newest stored error by its id, with its details."""
    ev = table(spark, d, "events")
    newest = ev.where(F.col("event_type") == "error").agg(F.max("event_id")).scalar()
    found = h.record(ev, "event_id", newest)
    return found.select("event_id", "ts", "value", F.try_element_at(h.json_details(F.col("props"), "map<string,int>"), F.lit("k")).alias("k"))


@query("paged_table", """SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM orders) AS total,
  CAST(ceil((SELECT count(*) FROM orders) / 25.0) AS BIGINT) AS pages FROM orders ORDER BY o_orderkey LIMIT 25 OFFSET 50""")
def paged_table(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return h.paged_table(orders, ["o_orderkey"], 3, 25)


@query("latest_n", "SELECT event_id, ts, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 500")
def latest_n(spark, d):
    ev = table(spark, d, "events").select("event_id", "ts", "value")
    return h.latest_n(ev, [F.desc("ts"), F.desc("event_id")], 500)


@query("json_details", r"""WITH j AS (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN left(props, length(props) - 2) ELSE props END AS props FROM events)
SELECT event_id, TRY_CAST(regexp_extract(props, '^\{"k": (\d+)\}$', 1) AS INTEGER) AS k,
  CASE WHEN regexp_matches(props, '^\{"k": (\d+)\}$') THEN 1 ELSE 0 END AS n_keys FROM j""")
def json_details(spark, d):
    ev = table(spark, d, "events")
    broken = F.expr("left(props, length(props) - 2)")
    raw = F.when(F.col("event_id") % 10 == 0, broken).otherwise(F.col("props"))
    m = h.json_details(raw, "map<string,int>")
    return ev.select(
        "event_id", F.try_element_at(m, F.lit("k")).alias("k"), F.size(m).alias("n_keys")
    )


@query("date_parts", """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso,
  CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(month(o_orderdate) AS INTEGER) AS mo FROM orders""")
def date_parts(spark, d):
    text = table(spark, d, "orders").withColumn("iso", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    parsed = F.to_timestamp("iso", "yyyy-MM-dd'T'HH:mm:ss")
    return text.select(
        "o_orderkey", "iso", F.year(parsed).alias("yr"), F.month(parsed).alias("mo")
    )


@query("latest_values", """SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id,
  arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id""")
def latest_values(spark, d):
    ev = table(spark, d, "events").select("user_id", "ts", "event_id", "value")
    return latest_per(ev, ["user_id"], ["ts", "event_id"]).drop("ts")
