"""Bulk ingest of JSON text."""

from pyspark.sql import functions as F


def parse_json(frame, raw, out="value"):
    """Add the text as a variant; malformed rows go to `json_quarantine`.

    An object that repeats a key counts as malformed, since no one value is right.
    """
    # Behind a generator the text is parsed once, not again for the filter.
    parsed = frame.withColumn(out, F.explode_outer(F.array(F.try_parse_json(raw))))
    return parsed.where(F.col(out).isNotNull() | F.col(raw).isNull())


def json_quarantine(frame, raw):
    """The rows whose text is not valid JSON."""
    return frame.where(F.try_parse_json(raw).isNull() & F.col(raw).isNotNull())


def read_json_files(spark, path, schema=None):
    """JSON files, one value per line, by Spark's reader."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)
