"""Landing of the three raw feeds with declared, all-text schemas.

JSON feeds are enveloped documents (``{"data": [...]}``) or newline-delimited
(``envelope=False``); both shapes give the same rows. A document that is larger
than what one task reads is read in ranges (`staylens.sources.envelope`), a
smaller one at once.

Reading never loses rows silently: paths are any that Spark reads (URIs,
folders, globs), a path that is given must exist, and a document, line or row
that does not parse fails the read. Only a source without a path is empty.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.sources.envelope import is_split, read_records
from staylens.schemas import (
    CLOUD_ENVELOPE, CLOUD_RESERVATION, NATIVE_ENVELOPE, NATIVE_EVENT, NORDIC_ROW,
)

# Envelope keys of the two JSON feeds.
NATIVE_ENVELOPE_KEY = "data"
CLOUD_ENVELOPE_KEY = "reservations"

FEED_SCHEMAS = {"native": NATIVE_EVENT, "nordic": NORDIC_ROW, "cloud": CLOUD_RESERVATION}


def _existing(read, path: str) -> DataFrame:
    """Run a reader; a path that matches nothing is a ``FileNotFoundError``."""
    try:
        return read()
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no such feed: {path!r}") from exc
        raise


def _read_json(spark: SparkSession, path: str, envelope_schema, record_schema, key: str,
               envelope: bool) -> DataFrame:
    reader = spark.read.option("mode", "FAILFAST")
    if envelope and _existing(lambda: is_split(spark, path), path):
        return read_records(spark, path, key, record_schema)
    if envelope:
        doc = _existing(lambda: reader.schema(envelope_schema).option("multiLine", True).json(path), path)
        # A document without the list (such as newline-delimited JSON read as
        # an envelope) must not pass for an empty feed.
        missing = F.raise_error(F.lit(f"no list {key!r} in a document of {path}")).cast(envelope_schema[key].dataType)
        return doc.select(F.inline(F.coalesce(F.col(key), missing)))
    return _existing(lambda: reader.schema(record_schema).json(path), path)


def read_native(spark: SparkSession, path: str, envelope: bool = True) -> DataFrame:
    """Native feed: one row per reservation event, every leaf text."""
    return _read_json(spark, path, NATIVE_ENVELOPE, NATIVE_EVENT, NATIVE_ENVELOPE_KEY, envelope)


def read_cloud(spark: SparkSession, path: str, envelope: bool = True) -> DataFrame:
    """Cloud feed: one row per reservation snapshot, camelCase text leaves."""
    return _read_json(spark, path, CLOUD_ENVELOPE, CLOUD_RESERVATION, CLOUD_ENVELOPE_KEY, envelope)


def read_csv_by_name(spark: SparkSession, path: str, schema) -> DataFrame:
    """A headed CSV as text, its columns found by header name. Columns not in
    ``schema`` are ignored, a missing one is an error, and so is a row that
    does not fit its header or a file whose header differs from the others."""
    raw = _existing(lambda: (spark.read.option("header", True).option("mode", "FAILFAST")
                             .option("enforceSchema", False).csv(path)), path)
    absent = [name for name in schema.names if name not in raw.columns]
    if absent:
        raise ValueError(f"{path}: no column {', '.join(absent)} in the header {raw.columns}")
    return raw.select(*[F.col(f"`{name}`") for name in schema.names])


def read_nordic(spark: SparkSession, path: str) -> DataFrame:
    """Nordic feed: headed CSV, one row per room-night, every column text."""
    return read_csv_by_name(spark, path, NORDIC_ROW)


def empty_feed(spark: SparkSession, source: str) -> DataFrame:
    """An empty raw feed with the declared schema (absent optional source)."""
    return spark.createDataFrame([], FEED_SCHEMAS[source])


def read_feed(spark: SparkSession, source: str, path: str, envelope: bool = True) -> DataFrame:
    """Read one feed; ``envelope`` says how a JSON feed is shaped."""
    if source == "nordic":
        return read_nordic(spark, path)
    return {"native": read_native, "cloud": read_cloud}[source](spark, path, envelope)


def load_all(spark: SparkSession, paths: Mapping[str, str | None],
             envelope: bool | Mapping[str, bool] = True) -> dict[str, DataFrame]:
    """Read every feed that has a path.

    ``native`` is required; ``nordic`` and ``cloud`` without a path become empty
    frames with their schema. ``envelope`` says, for all JSON feeds or per
    source, whether they are enveloped documents or newline-delimited.
    """
    feeds: dict[str, DataFrame] = {}
    for source in FEED_SCHEMAS:
        path = paths.get(source)
        shaped = envelope if isinstance(envelope, bool) else envelope.get(source, True)
        if path:
            feeds[source] = read_feed(spark, source, path, shaped)
        elif source == "native":
            raise FileNotFoundError("the native feed is required")
        else:
            feeds[source] = empty_feed(spark, source)
    return feeds


def load_raw(spark: SparkSession, path: str, source: str = "native", envelope: bool = True) -> int:
    """Read one feed and return its row count."""
    return read_feed(spark, source, path, envelope).count()
