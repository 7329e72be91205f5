"""Saved web responses: one row per response."""

from pyspark.sql import functions as F

BOM = "\ufeff"


def read_snapshots(spark, path, file_format="parquet", columns=None):
    """Saved responses as `url, fetched_at, status, headers, body`.

    `binaryFile` reads one response per file, with the file path as its URL.
    Other formats read a table; `columns` maps its columns to ours, and what is
    absent is null.
    """
    if file_format == "binaryFile":
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        return files.select(
            F.col("path").alias("url"),
            F.col("modificationTime").alias("fetched_at"),
            F.lit(None).cast("int").alias("status"),
            F.lit(None).cast("map<string,string>").alias("headers"),
            F.col("content").alias("body"),
        )
    table = spark.read.format(file_format).load(path)
    names = {ours: theirs for theirs, ours in (columns or {}).items()}
    types = {
        "url": "string",
        "fetched_at": "timestamp",
        "status": "int",
        "headers": "map<string,string>",
        "body": "binary",
    }
    return table.select(
        *[
            (F.col(names.get(c, c)) if names.get(c, c) in table.columns else F.lit(None)).cast(t).alias(c)
            for c, t in types.items()
        ]
    )


def body_text(body="body"):
    """The body as text, without a byte order mark."""
    return strip_bom(F.decode(F.col(body), "UTF-8"))


def strip_bom(text):
    """Text without a leading byte order mark."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.startswith(BOM), F.substr(text, F.lit(2))).otherwise(text)
