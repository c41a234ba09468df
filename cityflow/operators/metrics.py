"""Flow metrics.

The flow log has one row per notification: flow, service, result, duration_s, processed_at.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def normalise_log(log: DataFrame) -> DataFrame:
    """Flow log with the defaults in: unknown flow, default tenant, success unless error, duration >= 0."""
    duration = F.when(F.isnan("duration_s") | (F.abs("duration_s") == float("inf")), F.lit(0.0)).otherwise(
        F.coalesce("duration_s", F.lit(0.0))
    )
    return log.withColumns(
        {
            "flow": F.coalesce(F.nullif("flow", F.lit("")), F.lit("unknown")),
            "service": F.coalesce(F.nullif("service", F.lit("")), F.lit("default")),
            "result": F.when(F.col("result") == "error", "error").otherwise("success"),
            "duration_s": F.greatest(duration, F.lit(0.0)),
        }
    )


def flow_log(records: DataFrame, processed_at: Column, failed: Column) -> DataFrame:
    """Flow log of raw records with context; the duration is the time since the record was written."""
    return records.select(
        "flow",
        "service",
        F.when(failed, "error").otherwise("success").alias("result"),
        ((F.unix_millis(processed_at) - F.unix_millis("kafka_ts")) / 1000.0).alias("duration_s"),
        processed_at.alias("processed_at"),
    )


def flow_counts(log: DataFrame) -> DataFrame:
    """Messages by flow, tenant and result."""
    return normalise_log(log).groupBy("flow", "service", "result").agg(F.count(F.lit(1)).alias("messages"))


def flow_durations(log: DataFrame) -> DataFrame:
    """Last, total and mean duration by flow."""
    return normalise_log(log).groupBy("flow").agg(
        F.max_by("duration_s", "processed_at").alias("last_duration_s"),
        F.sum("duration_s").alias("total_duration_s"),
        F.round(F.avg("duration_s"), 6).alias("mean_duration_s"),
        F.max("processed_at").alias("last_processed_at"),
    )


def flow_summary(log: DataFrame) -> DataFrame:
    """Totals, successes, errors and durations by flow, sorted by flow."""
    return (
        normalise_log(log)
        .groupBy("flow")
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            F.count_if(F.col("result") == "success").alias("success_events"),
            F.count_if(F.col("result") == "error").alias("error_events"),
            F.max_by("duration_s", "processed_at").alias("last_duration_s"),
            F.round(F.avg("duration_s"), 6).alias("mean_duration_s"),
        )
        .orderBy("flow")
    )


def pipeline_snapshot(log: DataFrame) -> DataFrame:
    """One row: totals, success rate (1 when there are none), active tenants and flows."""
    total, good = F.count(F.lit(1)), F.count_if(F.col("result") == "success")
    # Counts per flow and tenant first, so the distinct counts work on that small result.
    by_pair = normalise_log(log).groupBy("flow", "service").agg(total.alias("n"), good.alias("ok"))
    events, successes = F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("ok"), F.lit(0))
    return by_pair.agg(
        events.alias("total_events"),
        successes.alias("success_events"),
        (events - successes).alias("error_events"),
        F.coalesce(F.round(F.try_divide(successes, events), 6), F.lit(1.0)).alias("success_rate"),
        F.count_distinct("service").alias("active_services"),
        F.count_distinct("flow").alias("active_flows"),
    )


def throughput(records: DataFrame, width: str = "1 minute", slide: str | None = None, unit_seconds: float = 1.0,
               by: str = "flow", watermark: str | None = None) -> DataFrame:
    """Records per window and flow (or topic), with their rate per `unit_seconds` (1: per second, 60: per minute).

    Sliding windows whose width is a whole number of slides are sums of counts per slide, so a record is
    counted once and only counts are spread over windows; a stream with a watermark does so in two stateful
    operators of one query, the second over the event time of the first one's windows. For other widths, and in a stream
    without a watermark, records are spread.
    """
    if watermark:
        records = records.withWatermark("kafka_ts", watermark)
    one = F.count(F.lit(1)).alias("records")
    if slide and _whole_slides(width, slide) and (watermark or not records.isStreaming):
        per_slide = records.groupBy(F.window("kafka_ts", slide).alias("s"), by).agg(one)
        spread = per_slide.select(F.window_time("s").alias("at"), by, "records")
        counted = spread.groupBy(F.window("at", width, slide).alias("w"), by).agg(F.sum("records").alias("records"))
    else:
        window = F.window("kafka_ts", width, slide) if slide else F.window("kafka_ts", width)
        counted = records.groupBy(window.alias("w"), by).agg(one)
    seconds = (F.unix_micros("w.end") - F.unix_micros("w.start")) / 1e6
    return counted.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        by,
        "records",
        (F.col("records") * F.lit(unit_seconds) / seconds).alias("rate"),
    )


_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _whole_slides(width: str, slide: str) -> bool:
    """Whether a window is made of whole slides; unknown for lengths not given as a number and a unit."""
    lengths = []
    for text in (width, slide):
        number, _, unit = text.strip().partition(" ")
        unit = unit.strip().lower().removesuffix("s")
        if not number.isdigit() or unit not in _SECONDS:
            return False
        lengths.append(int(number) * _SECONDS[unit])
    return lengths[1] > 0 and lengths[0] % lengths[1] == 0


def consumer_lag(end_offsets: DataFrame, done_offsets: DataFrame) -> DataFrame:
    """Records not yet processed, by consumer group and topic, summed over partitions.

    `end_offsets` has topic, partition, offset; `done_offsets` has these and consumer_group. Both are
    reduced to one row per partition before they meet, so the join is over partitions, not records. A
    partition a group has not touched counts whole.
    """
    ends = end_offsets.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end"))
    done = done_offsets.groupBy("consumer_group", "topic", "partition").agg((F.max("offset") + 1).alias("done"))
    wanted = done.select("consumer_group", "topic").distinct().join(ends, "topic")
    lag = F.greatest(F.col("end") - F.coalesce("done", F.lit(0)), F.lit(0))
    return (
        wanted.join(done, ["consumer_group", "topic", "partition"], "left")
        .groupBy("consumer_group", "topic")
        .agg(F.sum(lag).alias("lag"))
    )


def partition_count(records: DataFrame) -> DataFrame:
    """Number of partitions by topic."""
    pairs = records.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("topic").agg(F.count(F.lit(1)).alias("partitions"))


def observe_flow(rows: DataFrame, name: str | Observation) -> DataFrame:
    """Rows unchanged, with counts taken on the way past: rows, rejects, oldest and newest record.

    With an Observation the counts are read from it after a batch action; with a name they are part of
    the progress of a streaming query.
    """
    metrics = [F.count(F.lit(1)).alias("rows")]
    if "reject" in rows.columns:
        metrics.append(F.count_if(F.col("reject").isNotNull()).alias("rejects"))
    if "kafka_ts" in rows.columns:
        metrics += [F.min("kafka_ts").alias("oldest"), F.max("kafka_ts").alias("newest")]
        # Progress reports cut times to seconds.
        metrics += [F.unix_micros(F.min("kafka_ts")).alias("oldest_us"), F.unix_micros(F.max("kafka_ts")).alias("newest_us")]
    return rows.observe(name, *metrics)


# ---- numbers of running queries --------------------------------------------------------------------

#: Names that observed counts of a flow, and observed offsets, begin with in the progress of a query.
FLOW_NAME, OFFSETS_NAME = "flow/", "offsets"


def observe_offsets(records: DataFrame, partitions: Mapping[str, int]) -> DataFrame:
    """Records unchanged, with the last offset of every partition taken on the way past (`partitions`: their number by topic).

    For sources that do not report offsets themselves, such as files; `source_offsets` reads those that do.
    """
    here = lambda topic, p: (F.col("topic") == topic) & (F.col("partition") == p)
    last = [
        F.max(F.when(here(topic, p), F.col("offset"))).alias(f"{topic}/{p}") for topic, n in partitions.items() for p in range(n)
    ]
    return records.observe(OFFSETS_NAME, *last) if last else records


_PROGRESS = (
    "id string, runId string, name string, batchId long, timestamp string, durationMs map<string,long>, "
    "observedMetrics map<string,map<string,string>>, sources array<struct<description:string,endOffset:string,latestOffset:string>>"
)


def progress_rows(texts: DataFrame) -> DataFrame:
    """Progress of queries from its JSON, in `value`: one row per micro-batch; a batch reported twice counts once."""
    parsed = texts.select(F.from_json("value", _PROGRESS).alias("p")).select("p.*").where("id IS NOT NULL")
    return parsed.dropDuplicates(["id", "runId", "batchId", "timestamp"])


def progress_log(progress: DataFrame) -> DataFrame:
    """Flow log of running queries: one row for each flow, result and micro-batch, with how many notifications it had.

    The duration is how long the batch took, and `oldest` and `newest` are the times of its records.
    """
    each = progress.select("id", "batchId", "timestamp", "durationMs", F.explode("observedMetrics").alias("name", "m"))
    counts = each.where(F.col("name").startswith(FLOW_NAME)).withColumns(
        {
            "flow": F.substr("name", F.lit(len(FLOW_NAME) + 1)),
            "rows": F.coalesce(F.col("m")["rows"].cast("long"), F.lit(0)),
            "rejects": F.coalesce(F.try_element_at("m", F.lit("rejects")).cast("long"), F.lit(0)),
        }
    )
    parts = F.array(
        F.struct(F.lit("success").alias("result"), (F.col("rows") - F.col("rejects")).alias("messages")),
        F.struct(F.lit("error").alias("result"), F.col("rejects").alias("messages")),
    )
    told = counts.withColumn("part", F.explode(F.filter(parts, lambda p: p["messages"] > 0)))
    return told.select(
        F.col("id").alias("query"),
        F.col("batchId").alias("batch"),
        "flow",
        "part.result",
        "part.messages",
        (F.try_element_at("durationMs", F.lit("triggerExecution")) / 1000.0).alias("duration_s"),
        F.col("timestamp").cast("timestamp").alias("processed_at"),
        F.timestamp_micros(F.try_element_at("m", F.lit("oldest_us")).cast("long")).alias("oldest"),
        F.timestamp_micros(F.try_element_at("m", F.lit("newest_us")).cast("long")).alias("newest"),
    )


def observed_offsets(progress: DataFrame) -> DataFrame:
    """Last offset of each partition that a query has read, as observed: consumer_group, topic, partition, offset.

    The group is the name of the query, or its id where it has none.
    """
    held = progress.select(_group(), F.explode(F.try_element_at("observedMetrics", F.lit(OFFSETS_NAME))).alias("place", "offset"))
    cut = F.length("place") - F.locate("/", F.reverse("place")) + 1
    read = held.where(F.col("offset").isNotNull()).select(
        "consumer_group",
        F.substr("place", F.lit(1), cut - 1).alias("topic"),
        F.substr("place", cut + 1).cast("int").alias("partition"),
        F.col("offset").cast("long").alias("offset"),
    )
    return read.groupBy("consumer_group", "topic", "partition").agg(F.max("offset").alias("offset"))


def source_offsets(progress: DataFrame, which: str = "endOffset") -> DataFrame:
    """Last offset of each partition as sources report it (`endOffset`: read, `latestOffset`: there are).

    Sources that do not count by topic and partition, such as files, give no rows.
    """
    each = progress.select(_group(), "batchId", F.explode("sources").alias("s"))
    topics = each.select("consumer_group", "batchId", F.explode(F.from_json(f"s.{which}", "map<string,string>")).alias("topic", "ends"))
    ends = topics.select("consumer_group", "topic", F.explode(F.from_json("ends", "map<string,long>")).alias("partition", "end"))
    held = ends.where(F.col("partition").try_cast("int").isNotNull() & (F.col("end") > 0)).select(
        "consumer_group", "topic", F.col("partition").cast("int").alias("partition"), (F.col("end") - 1).alias("offset")
    )
    return held.groupBy("consumer_group", "topic", "partition").agg(F.max("offset").alias("offset"))


def _group() -> Column:
    return F.coalesce("name", "id").alias("consumer_group")
