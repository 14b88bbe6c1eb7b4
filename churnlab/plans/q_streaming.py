"""Registered streaming query: the events table read as a stream, daily
activity per event type, drained with ``availableNow``. All events count, in
whatever order their files arrive, so the batch twin is the plain aggregate."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift as DR
from ..session import scratch_path
from ..sources.tables import table
from ..streaming.monitor import drain_partials, drain_sketches
from .registry import register


@register("h10_stream_event_activity", """
w AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS ws, event_type, value FROM events),
g AS (SELECT ws, ws + INTERVAL 1 DAY AS we, event_type, count(*) AS events, sum(value) AS sum_value
      FROM w GROUP BY ws, event_type)
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(we, '%Y-%m-%d %H:%M:%S') AS window_end,
       event_type, events, round(sum_value, 6) AS sum_value
FROM g""")
def h10_stream_event_activity(spark, sf):
    schema = table(spark, sf, "events").schema
    # a pattern, as a stream takes one file or a folder of part files only through one
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{sf}/events.parque[t]")
    # ts is a wall-clock (NTZ) column: read it as UTC whatever the session zone,
    # so day windows are UTC days, and print the window bounds back in UTC
    tz = spark.conf.get("spark.sql.session.timeZone")
    stream = stream.withColumn(
        "ts", F.convert_timezone(F.lit("UTC"), F.lit(tz), F.col("ts").cast("timestamp_ntz")).cast("timestamp"))
    out = drain_partials(stream, scratch_path(spark, "activity"), scratch_path(spark, "stream-ckpt"))
    fmt = "yyyy-MM-dd HH:mm:ss"

    def wall(c):
        return F.date_format(F.convert_timezone(F.lit(tz), F.lit("UTC"), F.col(c).cast("timestamp_ntz")), fmt)
    return out.select(wall("window_start").alias("window_start"), wall("window_end").alias("window_end"),
                      "event_type", "events", F.round("sum_value", 6).alias("sum_value"))


_BASE_END = "2024-01-15"


@register("h10_stream_event_drift", f"""
e AS (SELECT CAST(ts AS DATE) AS "day", value, event_type FROM events),
base AS (SELECT * FROM e WHERE "day" < DATE '{_BASE_END}'),
b AS (SELECT "day", 'value' AS feature, CASE WHEN value IS NULL THEN '<null>' ELSE len(list_filter((SELECT
        quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) FROM base), lambda x: x < value))::VARCHAR END AS bin FROM e
      UNION ALL SELECT "day", 'event_type', CASE WHEN event_type IS NULL THEN '<null>'
        WHEN event_type IN (SELECT event_type FROM base) THEN event_type ELSE '<other>' END FROM e),
p AS (SELECT feature, bin, count(*) / sum(count(*)) OVER (PARTITION BY feature) AS p FROM b WHERE "day" < DATE '{_BASE_END}' GROUP BY feature, bin),
c AS (SELECT "day", feature, bin, count(*) AS n FROM b WHERE "day" >= DATE '{_BASE_END}' GROUP BY "day", feature, bin),
t AS (SELECT "day", feature, sum(n) AS t FROM c GROUP BY "day", feature),
k AS (SELECT "day", feature, bin FROM t JOIN p USING (feature) UNION SELECT "day", feature, bin FROM c),
j AS (SELECT k."day", k.feature, t.t, greatest(coalesce(p.p, 0), 1e-6) AS p, greatest(coalesce(c.n, 0) / t.t, 1e-6) AS q
      FROM k JOIN t ON t."day" = k."day" AND t.feature = k.feature LEFT JOIN p ON p.feature = k.feature AND p.bin = k.bin
      LEFT JOIN c ON c."day" = k."day" AND c.feature = k.feature AND c.bin = k.bin)
SELECT "day", feature, max(t)::BIGINT AS "rows", sum((q - p) * ln(q / p)) AS psi FROM j GROUP BY "day", feature""")
def h10_stream_event_drift(spark, sf):
    # the second half of the events arrives as a stream; sketches by day against the first half
    day = F.to_date("ts").alias("day")
    batch = table(spark, sf, "events").select(day, "value", "event_type")
    base = batch.filter(F.col("day") < F.lit(_BASE_END).cast("date"))
    lay = DR.layout(base, ["value"], ["event_type"])
    schema = table(spark, sf, "events").schema
    rows = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{sf}/events.parque[t]")
            .select(day, "value", "event_type").filter(F.col("day") >= F.lit(_BASE_END).cast("date")))
    got = drain_sketches(rows, lay, scratch_path(spark, "sketches"), scratch_path(spark, "sketch_stream"), by=["day"])
    return DR.psi(DR.sketch(base, lay), got, by=["day"])
