"""Metrics, job status and configuration queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.operators import metrics, status
from harvestry.plans.registry import query, stamp, table, to6
from harvestry.session import spread

HOUR, MINUTE = 3600, 60


def with_lifecycle(events: DataFrame) -> DataFrame:
    """Events as item lifecycles: scheduled at ``ts``, received k seconds later (from the
    JSON properties), scraped ``value`` seconds after that, of a size of 1000 + k bytes."""
    events = events.withColumn("_k", F.get_json_object("props", "$.k").cast("long"))
    k = F.col("_k")

    def later(seconds):
        return F.col("ts") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))

    return events.select(
        "event_id", F.col("ts").alias("schedule_time"),
        later(k).alias("received_time"),
        later(k + F.round("value", 6).cast("decimal(18,6)")).alias("scraped_time"),
        (k + 1000).alias("size"))


def lifecycles(spark, sf_dir) -> DataFrame:
    return with_lifecycle(table(spark, sf_dir, "events"))


# Lifecycle moments in microseconds.
LIVES_SQL = """
    k AS (SELECT event_id, epoch_us(ts) AS sched, CAST(props::JSON->>'k' AS BIGINT) AS k, value
          FROM events),
    lives AS (SELECT event_id, sched, sched + k * 1000000 AS recv, k + 1000 AS size,
                     sched + k * 1000000 + CAST(round(value * 1000000) AS BIGINT) AS scraped
              FROM k)"""


def sums_sql(seconds: int) -> str:
    step = seconds * 1000000
    return f"""{LIVES_SQL},
    sums AS (SELECT scraped // {step} AS tick, count(*) AS items,
                    sum(scraped - sched) AS latency_us, sum(scraped - recv) AS pipeline_us
             FROM lives GROUP BY 1)"""


def rates_sql(seconds: int, source: str = "sums") -> str:
    return f"""
    SELECT strftime(make_timestamp(CAST(tick * {seconds * 1000000} AS BIGINT)),
                    '%Y-%m-%d %H:%M:%S') AS start,
           coalesce(items, 0) AS items, round(coalesce(items, 0) / {seconds}.0, 6) AS rate,
           round(coalesce(latency_us / items / 1000000, 0), 6) AS latency,
           round(coalesce(pipeline_us / items / 1000000, 0), 6) AS pipeline
    FROM {source}"""


def rates(sums: DataFrame, seconds: int) -> DataFrame:
    return metrics.interval_rates(sums, seconds).select(
        stamp("start").alias("start"), "items", *to6("rate", "latency", "pipeline"))


@query(f"WITH {sums_sql(HOUR)} {rates_sql(HOUR)}")
def interval_metrics(spark, sf_dir):
    """Throughput and latencies per hour."""
    return rates(metrics.interval_sums(lifecycles(spark, sf_dir), HOUR), HOUR)


@query(f"""WITH {sums_sql(MINUTE)},
    ticks AS (SELECT unnest(range(min(tick), max(tick) + 1)) AS tick FROM sums),
    filled AS (SELECT * FROM ticks LEFT JOIN sums USING (tick))
    {rates_sql(MINUTE, 'filled')}""")
def interval_metrics_filled(spark, sf_dir):
    """Per minute, idle minutes included."""
    sums = metrics.interval_sums(lifecycles(spark, sf_dir), MINUTE)
    return rates(metrics.fill_intervals(sums, MINUTE), MINUTE)


GAUGES = [
    metrics.Gauge("scheduled", "schedule_time", "received_time"),
    metrics.Gauge("scraping", "received_time", "scraped_time"),
    metrics.Gauge("done", "scraped_time"),
    metrics.Gauge("bytes", "received_time", "scraped_time", "size"),
]


def _gauge_sql(name: str, moment: str, amount: str) -> str:
    step = MINUTE * 1000000
    return (f"SELECT '{name}' AS gauge, ({moment} + {step - 1}) // {step} AS tick, "
            f"{amount} AS change FROM lives")


def gauges_sql(changes: str) -> str:
    return f"""WITH {LIVES_SQL},
    changes AS ({changes}),
    per_tick AS (SELECT gauge, tick, sum(change) AS change FROM changes GROUP BY 1, 2),
    ticks AS (SELECT unnest(range(min(tick), max(tick) + 1)) AS tick FROM per_tick),
    dense AS (SELECT g.gauge, t.tick FROM ticks t, (SELECT DISTINCT gauge FROM changes) g)
    SELECT tick, gauge, CAST(sum(coalesce(change, 0)) OVER (
             PARTITION BY gauge ORDER BY tick) AS BIGINT) AS value
    FROM dense LEFT JOIN per_tick USING (gauge, tick)"""


INFLIGHT_SQL = gauges_sql(" UNION ALL ".join([
    _gauge_sql("scheduled", "sched", "1"), _gauge_sql("scheduled", "recv", "-1"),
    _gauge_sql("scraping", "recv", "1"), _gauge_sql("scraping", "scraped", "-1"),
    _gauge_sql("done", "scraped", "1"),
    _gauge_sql("bytes", "recv", "size"), _gauge_sql("bytes", "scraped", "-size")]))


@query(INFLIGHT_SQL)
def inflight_gauges(spark, sf_dir):
    """What was in flight at every full minute."""
    return metrics.gauges(lifecycles(spark, sf_dir), GAUGES, MINUTE)


@query(f"""
    SELECT tick, format('{{:8d}}{{:8d}}{{:8d}}{{:10d}}',
             max(value) FILTER (gauge = 'scheduled'), max(value) FILTER (gauge = 'scraping'),
             max(value) FILTER (gauge = 'done'), max(value) FILTER (gauge = 'bytes')) AS line
    FROM ({INFLIGHT_SQL}) GROUP BY tick""")
def gauge_lines(spark, sf_dir):
    """The samples as log lines."""
    samples = metrics.gauges(lifecycles(spark, sf_dir), GAUGES, MINUTE)
    return metrics.gauge_table(samples, GAUGES).select("tick", "line")


STATES = [
    metrics.Gauge("scheduled", "schedule_time", "fetch_time"),
    metrics.Gauge("downloading", "fetch_time", "received_time"),
    metrics.Gauge("scraping", "received_time", "scraped_time"),
    metrics.Gauge("in pipeline", "scraped_time", "stored_time"),
    metrics.Gauge("done", "stored_time"),
    metrics.Gauge("bytes", "received_time", "scraped_time", "size"),
]
_STATE_SQL = " UNION ALL ".join([
    _gauge_sql("scheduled", "sched", "1"), _gauge_sql("scheduled", "asked", "-1"),
    _gauge_sql("downloading", "asked", "1"), _gauge_sql("downloading", "recv", "-1"),
    _gauge_sql("scraping", "recv", "1"), _gauge_sql("scraping", "scraped", "-1"),
    _gauge_sql("in pipeline", "scraped", "1"), _gauge_sql("in pipeline", "stored", "-1"),
    _gauge_sql("done", "stored", "1"),
    _gauge_sql("bytes", "recv", "size"), _gauge_sql("bytes", "scraped", "-size")])


@query(gauges_sql(_STATE_SQL.replace("FROM lives", """FROM (
    SELECT *, sched + (size - 1000) // 2 * 1000000 AS asked,
           scraped + (size - 1000) % 7 * 1000000 AS stored FROM lives)""")))
def inflight_states(spark, sf_dir):
    """All six states a lifecycle passes: the download starts halfway to the reply, and the
    pipelines take up to six seconds."""
    def later(moment, seconds):
        return F.col(moment) + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))

    k = F.col("size") - 1000
    items = lifecycles(spark, sf_dir).withColumns({
        "fetch_time": later("schedule_time", F.floor(k / 2)),
        "stored_time": later("scraped_time", k % 7)})
    return metrics.gauges(items, STATES, MINUTE)


@query(f"""WITH {sums_sql(HOUR)}
    SELECT strftime(make_timestamp(CAST(tick * {HOUR * 1000000} AS BIGINT)),
                    '%Y-%m-%d %H:%M:%S') AS start,
           format('Scraped {{:d}} items at {{:.1f}} items/s, avg latency: {{:.2f}} s and avg '
                  || 'time in pipelines: {{:.2f}} s', items, round(items / {HOUR}.0, 1),
                  CAST(round(CAST(latency_us / items / 1000000 AS DECIMAL(28, 9)), 2) AS DOUBLE),
                  CAST(round(CAST(pipeline_us / items / 1000000 AS DECIMAL(28, 9)), 2) AS DOUBLE))
             AS line
    FROM sums""")
def report_lines(spark, sf_dir):
    """The hourly metrics as log lines."""
    sums = metrics.interval_sums(lifecycles(spark, sf_dir), HOUR)
    return metrics.interval_rates(sums, HOUR).select(
        stamp("start").alias("start"), metrics.report_line().alias("line"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def signal_counts(spark, sf_dir):
    return metrics.signal_counts(table(spark, sf_dir, "events"))


@query("""
    SELECT user_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start,
           count(*) AS calls
    FROM events GROUP BY user_id, date_trunc('hour', ts) HAVING count(*) > 1""")
def rate_violations(spark, sf_dir):
    """Users with more than one call within an hour."""
    found = metrics.rate_violations(table(spark, sf_dir, "events"), "user_id", "ts", 1, HOUR)
    return found.select("user_id", stamp("start").alias("start"), "calls")


@query("""
    SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, calls FROM (
      SELECT user_id, ts, count(*) OVER (PARTITION BY user_id ORDER BY ts
               RANGE BETWEEN INTERVAL 3599999999 MICROSECONDS PRECEDING AND CURRENT ROW) AS calls,
             lag(ts, 2) OVER (PARTITION BY user_id ORDER BY ts) AS earlier
      FROM events)
    WHERE epoch_us(ts) - epoch_us(earlier) < 3600000000""")
def rate_bursts(spark, sf_dir):
    """Calls of users who made more than two within any hour, also over the full hour."""
    found = metrics.rate_bursts(table(spark, sf_dir, "events"), "user_id", "ts", 2, HOUR)
    return found.select("user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
                        "calls")


@query("""
    SELECT target, running, finished, pending,
           format('{:<20s} running: {:d}, finished: {:d}, pending: {:d}',
                  target, running, finished, pending) AS line
    FROM (SELECT 'target' || event_id AS target, event_type, k % 4 AS running,
                 k % 3 AS finished, CASE WHEN k % 5 = 0 THEN 0 ELSE k % 5 END AS pending
          FROM (SELECT event_id, event_type, CAST(props::JSON->>'k' AS BIGINT) AS k
                FROM events))
    WHERE event_type <> 'error'""")
def job_status(spark, sf_dir):
    """Status replies, one per event: job lists sized by the properties, the pending list
    missing where it would be empty, errors answered with code 500."""
    events = spread(table(spark, sf_dir, "events").select(
        "event_id", "event_type", "props")).withColumn(
        "_k", F.get_json_object("props", "$.k").cast("int"))
    k = F.col("_k")

    def jobs(n):
        return F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(
            F.concat(F.lit("job"), i.cast("string")).alias("id")))

    def listed(n):
        empty = F.array().cast("array<struct<id:string>>")
        return F.when(n > 0, jobs(F.greatest(n, F.lit(1)))).otherwise(empty)

    replies = events.select(
        F.concat(F.lit("target"), F.col("event_id").cast("string")).alias("target"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("code"),
        F.to_json(F.struct(
            listed(k % 4).alias("running"), listed(k % 3).alias("finished"),
            F.when(k % 5 > 0, listed(k % 5)).alias("pending"))).alias("body"))
    return status.job_status(replies)


@query("""
    SELECT DISTINCT 'target' || event_id AS target FROM events
    WHERE event_type <> 'error' AND event_id IN (SELECT l_suppkey FROM lineitem)""")
def requested_status(spark, sf_dir):
    """The status of the targets asked for by name (one per supplier with line items), among
    those configured."""
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("target"), F.col("event_id").cast("string")).alias("target"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("code"),
        F.lit('{"running":[],"finished":[]}').alias("body"))
    asked = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("target"), F.col("l_suppkey").cast("string")).alias("target"))
    return status.job_status(events, status.asked_targets(events, asked)).select("target")


@query("""
    SELECT user_id AS target, count(*) FILTER (event_type = 'view') AS running,
           count(*) FILTER (event_type = 'purchase') AS finished,
           count(*) FILTER (event_type = 'click') AS pending
    FROM events GROUP BY user_id""")
def job_counts(spark, sf_dir):
    """Jobs per target and state from job rows."""
    state = (F.when(F.col("event_type") == "view", "running")
             .when(F.col("event_type") == "purchase", "finished")
             .when(F.col("event_type") == "click", "pending"))
    jobs = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("target"), state.alias("state"))
    return status.jobs_by_state(jobs)


@query("""
    WITH settings AS (
      SELECT 'deploy' AS section, lower(r_name) AS key, 'base ' || r_name AS value FROM region
      UNION ALL SELECT 'deploy', 'url', 'http://localhost:6800/' FROM region WHERE r_regionkey = 0
      UNION ALL SELECT 'settings', 'default', n_name FROM nation
      UNION ALL SELECT 'deploy:' || s_name, 'url', 'http://' || s_name || ':6800/' FROM supplier
      UNION ALL SELECT 'deploy:' || s_name, 'asia', 'own ' || s_nationkey FROM supplier
                WHERE s_acctbal > 5000),
    targets AS (
      SELECT DISTINCT section, section[8:] AS target FROM settings
      WHERE starts_with(section, 'deploy:')
      UNION ALL SELECT 'deploy', 'default'),
    pairs AS (
      SELECT t.section, target, key, value FROM targets t, settings s WHERE s.section = 'deploy')
    SELECT p.target, p.key, coalesce(s.value, p.value) AS value
    FROM pairs p LEFT JOIN settings s ON s.section = p.section AND s.key = p.key""")
def target_config(spark, sf_dir):
    """A section per supplier on top of shared defaults."""
    def rows(name, section, key, value):
        return table(spark, sf_dir, name).select(
            section.alias("section"), key.alias("key"), value.alias("value"))

    base, own = F.lit("deploy"), F.concat(F.lit("deploy:"), F.col("s_name"))
    settings = (
        rows("region", base, F.lower("r_name"), F.concat(F.lit("base "), "r_name"))
        .unionByName(table(spark, sf_dir, "region").filter("r_regionkey = 0").select(
            base.alias("section"), F.lit("url").alias("key"),
            F.lit("http://localhost:6800/").alias("value")))
        .unionByName(rows("nation", F.lit("settings"), F.lit("default"), F.col("n_name")))
        .unionByName(rows("supplier", own, F.lit("url"),
                          F.concat(F.lit("http://"), "s_name", F.lit(":6800/"))))
        .unionByName(table(spark, sf_dir, "supplier").filter("s_acctbal > 5000").select(
            own.alias("section"), F.lit("asia").alias("key"),
            F.concat(F.lit("own "), F.col("s_nationkey").cast("string")).alias("value"))))
    return status.target_config(settings)
