"""Counters, gauges and alert rules over metric samples (ts, metric, instance, value)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.merge import latest_per_key
from orderloom.operators.skew import HOT_ROWS, join_one_per_key
from orderloom.operators.windows import previous, running, sliding_sums
from orderloom.session import cut
from orderloom.sources.batches import BatchTable

RULE_SCHEMA = "rule string, metric string, operator string, threshold double, hold_seconds int, severity string"
# Alert thresholds on lag and usage.
DEFAULT_RULES = [
    ("replication_lag_warning", "lag_seconds", ">", 30.0, 120, "warning"),
    ("replication_lag_critical", "lag_seconds", ">", 120.0, 60, "critical"),
    ("io_thread_stopped", "io_running", "!=", 1.0, 30, "critical"),
    ("sql_thread_stopped", "sql_running", "!=", 1.0, 30, "critical"),
    ("connection_usage_high", "connection_pct", ">", 80.0, 300, "warning"),
    ("connection_usage_critical", "connection_pct", ">", 95.0, 60, "critical"),
    ("hit_rate_low", "hit_rate_pct", "<", 99.0, 600, "warning"),
    ("query_rate_high", "queries_per_second", ">", 5000.0, 300, "warning"),
    ("slow_query_spike", "slow_queries_per_second", ">", 10.0, 300, "warning"),
    ("disk_usage_warning", "disk_pct", ">", 80.0, 300, "warning"),
    ("disk_usage_critical", "disk_pct", ">", 90.0, 120, "critical"),
]


def counter_increase(samples: DataFrame, series: list[str], at: str, value: str, tie: str) -> DataFrame:
    """Adds ``increase`` since the sample before; a drop means the counter began again at zero."""
    stepped = previous(samples, series, [at, tie], {value: "_before"})
    step = F.when(F.col(value) >= F.col("_before"), F.col(value) - F.col("_before")).when(
        F.col("_before").isNotNull(), F.col(value)
    )
    return stepped.withColumn("increase", step).drop("_before")


def counter_rate(
    samples: DataFrame, series: list[str], at: str, value: str, tie: str, seconds: int, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Adds the increase over the last ``seconds`` and its rate per second at each sample; busy series are split."""
    stepped = counter_increase(samples, series, at, value, tie)
    summed = sliding_sums(stepped, series, at, seconds, {"increase_in_range": F.col("increase")}, hot_rows)
    return summed.withColumn("rate", F.col("increase_in_range") / seconds)


def tumbling_increase(stepped: DataFrame, series: list[str], at: str, width: str) -> DataFrame:
    """Increase per fixed window; sums up on the map side."""
    return stepped.groupBy(*series, F.window(F.col(at), width).alias("_w")).agg(
        F.sum("increase").alias("increase")
    ).select(*series, F.col("_w.start").alias("window_start"), "increase")


def wide(samples: DataFrame, keys: list[str], names: list[str], value: Column | None = None) -> DataFrame:
    """One column per listed metric name."""
    amount = F.col("value") if value is None else value
    return samples.groupBy(*keys).agg(*[F.max(F.when(F.col("metric") == n, amount)).alias(n) for n in names])


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part * 100, whole)


def rules_table(spark: SparkSession, rules: list[tuple] | None = None) -> DataFrame:
    return spark.createDataFrame(rules or DEFAULT_RULES, RULE_SCHEMA)


def breaches(samples: DataFrame, rules: DataFrame) -> DataFrame:
    """Each sample under each rule on its metric, with whether it breaks the rule.

    ``rules`` comes from ``rules_table``, a short list by nature.
    """
    value, limit, op = F.col("value"), F.col("threshold"), F.col("operator")
    broken = (
        F.when(op == ">", value > limit)
        .when(op == "<", value < limit)
        .when(op == ">=", value >= limit)
        .when(op == "<=", value <= limit)
        .when(op == "!=", value != limit)
        .otherwise(F.raise_error(F.concat(F.lit("unknown operator "), op)).cast("boolean"))
    )
    return samples.join(rules, "metric").withColumn("broken", F.coalesce(broken, F.lit(False)))


def _islands(states: DataFrame, series: list[str], at: str, tie: str, broken: str) -> DataFrame:
    """Broken samples, numbered by the unbroken ones before them: equal within a stretch."""
    healthy = (~F.col(broken)).cast("long")
    return running(states, series, [at, tie], {"_island": healthy}).filter(broken)


def held(
    states: DataFrame, series: list[str], at: str, tie: str, broken: str, hold: Column
) -> DataFrame:
    """Stretches in which ``broken`` held without a break for at least ``hold`` seconds."""
    counted = _islands(states.withColumn("_hold", hold), series, at, tie, broken)
    stretches = counted.groupBy(*series, "_island").agg(
        F.min(at).alias("started_at"),
        F.max(at).alias("ended_at"),
        F.count(F.lit(1)).alias("samples"),
        F.first("_hold").alias("_hold"),
    )
    lasted = F.timestamp_diff("SECOND", F.col("started_at"), F.col("ended_at"))
    return stretches.filter(lasted >= F.col("_hold")).select(*series, "started_at", "ended_at", "samples")


def breaches_table(spark: SparkSession, path: str, series: list[str], empty: DataFrame) -> BatchTable:
    """Per series the start of the breach that is running (NULL if none) and whether it was reported.

    ``empty`` has the columns (series.., since, reported, seen_at).
    """

    def fold(base: DataFrame | None, batches: DataFrame | None) -> DataFrame:
        known = [df for df in (base, batches) if df is not None]
        return latest_per_key(reduce(DataFrame.unionByName, known), series, ["seen_at"]) if known else empty

    return BatchTable(spark, path, lambda batch: batch, fold)


def alert_writer(
    running_breaches: BatchTable,
    out: str,
    series: list[str],
    at: str,
    tie: str,
    broken: str,
    hold_seconds: int,
):
    """Alerts on a stream, as a ``foreachBatch`` function: one row in ``out`` per breach that held.

    A breach running from before joins the batch as its first sample, so that a
    batch is judged by the same windows as a history, hot series included. Batches
    must follow each other in time; a batch run again replaces its alerts.
    """

    def judge_batch(batch: DataFrame, batch_id: int) -> None:
        samples = cut(batch.select(*series, at, tie, broken), "samples")
        known = running_breaches.read(before=batch_id)
        earlier = known.filter("since IS NOT NULL").select(
            *series, F.col("since").alias(at), F.lit(-1).alias(tie), F.lit(True).alias(broken), "reported"
        )
        rows = cut(samples.withColumn("reported", F.lit(False)).unionByName(earlier), "samples")
        broken_rows = cut(_islands(rows, series, at, tie, broken), "breaches")
        stretches = broken_rows.groupBy(*series, "_island").agg(
            F.min(at).alias("started_at"), F.max(at).alias("ended_at"), F.bool_or("reported").alias("reported")
        )
        due = F.col("started_at") + F.make_dt_interval(secs=F.lit(hold_seconds))
        long_ones = stretches.filter(F.col("ended_at") >= due)
        fired = (
            join_one_per_key(broken_rows.drop("reported"), long_ones.filter("NOT reported"), [*series, "_island"])
            .filter(F.col(at) >= due)
            .groupBy(*series, "started_at")
            .agg(F.min(at).alias("fired_at"))
        )
        fired.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        last = rows.groupBy(*series).agg(F.max_by(broken, F.struct(at, tie)).alias("_open"), F.max(at).alias("seen_at"))
        newest = latest_per_key(stretches, series, ["started_at"])
        state = last.join(newest, series, "left").select(
            *series,
            F.when(F.col("_open"), F.col("started_at")).alias("since"),
            (F.col("_open") & (F.col("reported") | (F.col("ended_at") >= due))).alias("reported"),
            "seen_at",
        )
        running_breaches.write_batch(state, batch_id)

    return judge_batch
