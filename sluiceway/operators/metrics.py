"""Batch summaries, counters per reporting period, latency and health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Names under which a period is reported, and the latency above which it is unhealthy.
METRIC_GOOD = "events_good"
METRIC_BAD = "events_bad"
METRIC_LATENCY = "latency_millis"
METRIC_E2E_LATENCY = "e2e_latency_millis"
NEWEST_SOURCE = "newest_source_tstamp"
UNHEALTHY_MILLIS = 5 * 60 * 1000


def summary_columns(extra: list[Column] | tuple[Column, ...] = ()) -> list[Column]:
    """The measures of a batch, as aggregates for a grouping or for an observation of rows that are on their way elsewhere."""
    bad = F.col("failure").isNotNull()
    total = F.count("*")
    return [
        total.alias("n_events"),
        (total - F.count_if(bad)).alias("n_good"),
        F.count_if(bad).alias("n_bad"),
        F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n_bytes"),
        F.min("collector_tstamp").alias("earliest_collector_tstamp"),
        *extra,
    ]


def batch_summary(transformed: DataFrame, *by: str, extra: list[Column] | tuple[Column, ...] = ()) -> DataFrame:
    """Counts, bytes and the earliest collector time of a batch, or of each group in ``by``.

    ``transformed`` needs ``n_bytes``, ``failure`` and ``collector_tstamp``. Bytes include
    unparseable lines. The earliest time covers every parsed event, also one that fails later.
    """
    return transformed.groupBy(*by).agg(*summary_columns(extra))


def latency_millis(now: Column, since: Column) -> Column:
    """Milliseconds between two moments; null when there is no event to measure from."""
    return F.unix_millis(now) - F.unix_millis(since)


def per_period(batches: DataFrame, period: str = "1 minute", at: str = "load_tstamp") -> DataFrame:
    """Counters summed and latencies maximised per reporting period; each period starts afresh. Periods without batches have no row here."""
    newest = F.max(F.col(at) - F.make_interval(secs=F.col("latency_millis") / 1000))
    return batches.groupBy(F.window(at, period).alias("period")).agg(
        F.sum("n_good").alias(METRIC_GOOD),
        F.sum("n_bad").alias(METRIC_BAD),
        F.coalesce(F.max("latency_millis"), F.lit(0)).alias(METRIC_LATENCY),
        F.max("e2e_latency_millis").alias(METRIC_E2E_LATENCY),
        newest.alias(NEWEST_SOURCE),
    ).select(F.col("period.start").alias("period_start"), METRIC_GOOD, METRIC_BAD, METRIC_LATENCY, METRIC_E2E_LATENCY, NEWEST_SOURCE)


def every_period(periods: DataFrame, period: str = "1 minute", until: Column | None = None) -> DataFrame:
    """The same with a row for every period from the first to the last, or to the moment ``until``.

    A period without batches has no events, and its latency is the time from the newest record that any batch before it held to the period's end: a
    source that stalls, or a loader that hangs, lags more from period to period. Carrying that moment on is a running maximum over one row a period.
    """
    step = F.expr(f"interval {period}")
    last = F.max("period_start") if until is None else F.greatest(F.max("period_start"), until)
    span = periods.agg(F.min("period_start").alias("first_"), last.alias("last_")).where("first_ IS NOT NULL")
    calendar = span.select(F.explode(F.sequence("first_", "last_", step)).alias("period_start"))
    filled = calendar.join(periods, "period_start", "left")
    before = F.max(NEWEST_SOURCE).over(Window.orderBy("period_start").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    waited = latency_millis(F.col("period_start") + step, before)
    return filled.select(
        "period_start", F.coalesce(METRIC_GOOD, F.lit(0)).alias(METRIC_GOOD), F.coalesce(METRIC_BAD, F.lit(0)).alias(METRIC_BAD),
        F.coalesce(METRIC_LATENCY, waited, F.lit(0)).alias(METRIC_LATENCY), METRIC_E2E_LATENCY, before.alias(NEWEST_SOURCE))


def unhealthy(periods: DataFrame, limit_millis: int = UNHEALTHY_MILLIS) -> DataFrame:
    """Periods in which the source lagged more than the limit. With :func:`every_period` these include the ones in which nothing came."""
    return periods.filter(F.col(METRIC_LATENCY) > limit_millis)
