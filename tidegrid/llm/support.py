"""Small helpers that several operators share."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidegrid.session import scratch_path

# One Arrow batch is the block in which a task works; its size bounds memory.
BATCH_BYTES = "16m"
BATCH_ROWS = "10000"


def bound_batches(spark):
    """Let Spark cut the batches it hands to Python by bytes as well as by rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def id_and_text(frame, id, text):
    """Only the identifier and the text; a null text counts as empty."""
    return frame.select(F.col(id).alias(id), F.coalesce(F.col(text).cast("string"), F.lit("")).alias(text))


def raw(column):
    """The values of an Arrow text column as bytes."""
    return column.cast(pa.binary()).to_pylist()


def ragged(starts, lengths):
    """The indices of several runs, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    steps = np.ones(total, np.int64)
    full = lengths > 0
    starts, lengths = starts[full].astype(np.int64), lengths[full].astype(np.int64)
    steps[0] = starts[0]
    steps[np.cumsum(lengths)[:-1]] = starts[1:] - starts[:-1] - lengths[:-1] + 1
    return np.cumsum(steps)


def fields(schema):
    """An Arrow schema of a `name type, ...` list."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in schema.split(", "))])


def batch(schema, *columns):
    """One Arrow batch of a `name type, ...` list."""
    form = fields(schema)
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, form)], schema=form)


def cut(frame):
    """The frame as a checkpoint in the shared folder, computed now, with no lineage left."""
    context = frame.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(scratch_path(frame.sparkSession, "checkpoints"))
    return frame.checkpoint(eager=True)


def hashed_sample(frame, name, most, id="id", *ties):
    """At most `most` rows, the first by a hash of the identifier, the same on every run.

    Only a share that surely holds enough is put in order, so that what tasks
    send does not grow with their number.
    """
    key = F.xxhash64(F.lit(name), F.col(id))
    total = max(1, frame.count())
    return frame.filter(F.pmod(key, F.lit(total)) < 4 * most).orderBy(key, id, *ties).limit(most)


def _both(edges):
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(edges):
    """Connected components: (node, least), least being the smallest node reached; only of nodes that have an edge (u, v).

    Alternating stars: every node hands its larger neighbours, then its
    smaller ones, the smallest node it knows. Minima are aggregated before the
    shuffle; each round's edges are a checkpoint in the shared folder. It ends
    when a round changes nothing, after rounds that grow with the logarithm of the longest chain.
    """
    edges = cut(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        both = _both(edges)
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("least"))
        seen = now
