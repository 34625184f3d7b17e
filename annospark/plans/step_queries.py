"""Queries on a grid of steps: rates, quantiles of bucket rates, gauges."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import steps
from . import adapters as a
from .registry import query

DAY = 86_400
_GRID = "g AS (SELECT unnest(generate_series(date_trunc('day', min(ts)), max(ts) + INTERVAL 8 DAY, INTERVAL 1 DAY)) AS step FROM events)"


def _samples(spark, sf_dir):
    return a.table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", F.col("ts").cast("timestamp").alias("ts"), "value")


def _shown(found, *values):
    return found.select("event_type", F.col("step").cast("timestamp_ntz").alias("step"), *values)


@query(f"""WITH c AS (SELECT user_id, event_type, ts, floor(value) AS v, lag(ts) OVER w AS pts, lag(floor(value)) OVER w AS p FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, floor(value))), {_GRID},
  s AS (SELECT user_id, event_type, step, sum(CASE WHEN v < p THEN v ELSE v - p END) AS increase FROM c JOIN g ON step >= ts AND pts > step - INTERVAL 7 DAY GROUP BY 1, 2, 3)
  SELECT event_type, step, round(sum(increase) / 604800.0, 9) AS rate, count(*) AS series FROM s GROUP BY 1, 2""")
def step_rates(spark, sf_dir):
    """Counters that often begin anew, by day over the week before."""
    rows = _samples(spark, sf_dir).withColumn("value", F.floor("value").cast("double"))
    found = steps.summed_rates(steps.counter_steps(rows, ["user_id", "event_type"], DAY, 7 * DAY, 3 * DAY), ["event_type"])
    return _shown(found, F.round(F.col("increase") / (7 * DAY), 9).alias("rate"), "series")


@query(f"""WITH b AS (SELECT user_id, event_type, le, ts, count(*) FILTER (value <= le) OVER (PARTITION BY user_id, event_type, le ORDER BY ts, event_id) AS v FROM events, (VALUES (1.0::DOUBLE), (5.0), (20.0), (50.0), ('inf'::DOUBLE)) t(le)),
  c AS (SELECT *, lag(ts) OVER w AS pts, lag(v) OVER w AS p FROM b WINDOW w AS (PARTITION BY user_id, event_type, le ORDER BY ts, v)), {_GRID},
  s AS (SELECT event_type, step, le, sum(v - p) AS n FROM c JOIN g ON step >= ts AND pts > step - INTERVAL 7 DAY GROUP BY 1, 2, 3),
  r AS (SELECT *, max(n) OVER (PARTITION BY event_type, step) AS total, coalesce(lag(le) OVER w, 0) AS low, coalesce(lag(n) OVER w, 0) AS under FROM s WINDOW w AS (PARTITION BY event_type, step ORDER BY le)),
  h AS (SELECT *, row_number() OVER (PARTITION BY event_type, step ORDER BY le) AS nth FROM r WHERE total > 0 AND n >= 0.9 * total)
  SELECT event_type, step, round(CASE WHEN le = 'inf'::DOUBLE THEN low ELSE low + (le - low) * (0.9 * total - under) / (n - under) END, 6) AS value FROM h WHERE nth = 1""")
def step_quantiles(spark, sf_dir):
    """The 0.9 quantile of what bucket counters gained in a week, by day."""
    bounds = [1.0, 5.0, 20.0, 50.0, float("inf")]
    order = Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id")
    counts = F.array(*(F.count_if(F.col("value") <= le).over(order).cast("double") for le in bounds))
    # by number, so that these partitions stay: put together by their compressed size, they would be large where they are sorted
    dealt = _samples(spark, sf_dir).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "user_id", "event_type")
    rows = dealt.select("user_id", "event_type", "ts", counts.alias("value"))
    found = steps.histogram_steps(rows, ["user_id", "event_type"], ["event_type"], 0.9, DAY, 7 * DAY, 3 * DAY, bounds)
    return _shown(found, F.round("value", 6).alias("value"))


@query(f"""WITH {_GRID}, s AS (SELECT user_id, event_type, step, arg_max(value, ts) AS v FROM events JOIN g ON step >= ts AND ts > step - INTERVAL 2 DAY GROUP BY 1, 2, 3),
  t AS (SELECT event_type, step, sum(v) AS total, avg(v) AS mean, count(*) FILTER (v > 0) AS up FROM s GROUP BY 1, 2)
  SELECT k.event_type, g.step, round(coalesce(total, 0), 6) AS total, round(coalesce(mean, 0), 6) AS mean, coalesce(up, 0) AS up FROM (SELECT DISTINCT event_type FROM events) k CROSS JOIN g LEFT JOIN t ON t.event_type = k.event_type AND t.step = g.step""")
def step_gauges(spark, sf_dir):
    """Latest samples of two days by day, zeros where a kind of event has none."""
    rows = _samples(spark, sf_dir)
    found = steps.gauge_totals(steps.gauge_steps(rows, ["user_id", "event_type"], DAY, 2 * DAY), ["event_type"])
    low, high = rows.agg(F.min(F.unix_seconds("ts")), F.max(F.unix_seconds("ts"))).first()
    grid = steps.step_grid(spark, low // DAY * DAY, high + 8 * DAY, DAY) if low is not None else steps.step_grid(spark, DAY, 0, DAY)
    filled = steps.or_zero(found, rows.select("event_type"), grid, ["event_type"], ["total", "mean", "up"])
    return _shown(filled, F.round("total", 6).alias("total"), F.round("mean", 6).alias("mean"), "up")
