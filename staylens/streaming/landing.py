"""File-source stream: new raw feed files -> all-text Parquet landing zone."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from staylens.schemas import CLOUD_ENVELOPE, NATIVE_ENVELOPE
from staylens.session import ensure_checkpoint_dir
from staylens.sources.feeds import CLOUD_ENVELOPE_KEY, FEED_SCHEMAS, NATIVE_ENVELOPE_KEY

_ENVELOPES = {"native": (NATIVE_ENVELOPE, NATIVE_ENVELOPE_KEY), "cloud": (CLOUD_ENVELOPE, CLOUD_ENVELOPE_KEY)}


def land_stream(spark: SparkSession, source: str, input_dir: str, landing_dir: str,
                checkpoint_dir: str | None = None, envelope: bool = False,
                max_files_per_trigger: int | None = None,
                available_now: bool = True) -> StreamingQuery:
    """Start a stream landing every new file of ``input_dir`` into
    ``landing_dir`` (Parquet, append). ``source`` is native, nordic or cloud.

    JSON feeds are read as newline-delimited events by default; with
    ``envelope=True`` each file is one enveloped document whose list is
    unnested. The stream's progress is kept in ``checkpoint_dir`` (default:
    under ``spark.checkpoint.dir``), so a restarted or re-triggered stream
    lands each file once. ``available_now`` processes what is there and
    stops, which suits a scheduled landing job.
    """
    reader = spark.readStream.option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if source == "nordic":
        df = reader.schema(FEED_SCHEMAS["nordic"]).option("header", True).option("enforceSchema", False).csv(input_dir)
    elif envelope:
        schema, key = _ENVELOPES[source]
        df = reader.schema(schema).option("multiLine", True).json(input_dir).select(F.inline(F.col(key)))
    else:
        df = reader.schema(FEED_SCHEMAS[source]).json(input_dir)
    checkpoint = checkpoint_dir or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/landing-{source}"
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(landing_dir)
