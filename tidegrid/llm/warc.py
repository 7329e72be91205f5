"""Web archives (WARC) of one Zstandard frame a record.

An archive begins with a skippable frame that holds the dictionary of all its
frames; each record after it is one frame, so that any record can be read by
itself. Spark's text writer lays the frames into files. Its line separator is
an empty skippable frame, which every reader of such files passes over, so the
files are archives as they are. The writer begins a new file after a fixed
number of rows; an archive that reaches its size before is filled up with empty
rows, each an empty frame, so that the size is bounded without a shuffle.
"""

import hashlib
import re
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import functions as F

from tidegrid.llm.support import batch, bound_batches, hashed_sample
from tidegrid.operators.series import join_on_key
from tidegrid.session import store

# Fixed values of the formats: frame magics, and the skippable one that holds a dictionary.
FRAME, DICTIONARY, RAW_DICTIONARY = 0xFD2FB528, 0x184D2A5D, 0xEC30A437
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
# An empty skippable frame, all of it ASCII.
SEPARATOR = "P*M\x18\x00\x00\x00\x00"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")

FLUSH_BYTES = 16 << 20
# Rows of one file: the dictionary, the records, and what fills it up.
FILE_ROWS = 8192
RECORD = "archive string, offset long, record_id string, record_type string, target_uri string, date string, refers_to string, payload_digest string, payload_bytes long, payload binary, problem string"


def record_id(id, digest):
    """The name of the record of a row: its identifier, if it has one, and its payload."""
    key = F.concat(F.lit("<urn:page:"), F.url_encode(id.cast("string")), F.lit("/"), digest, F.lit(">"))
    return F.coalesce(key, F.concat(F.lit("<urn:no-page:"), digest, F.lit(">")))


def row_id(name, kind):
    """The identifier in a record's name, null if it had none."""
    held = F.regexp_extract(name, "^<urn:page:([^/]*)/", 1)
    return F.when(name.startswith("<urn:page:"), F.try_url_decode(held)).cast(kind)


def train(frame, id="page_id", payload="html", pages=256, slice_bytes=16_384, size=65_536):
    """A dictionary of at most `size` bytes, from slices of at most `pages` payloads; None where these are too few to train one."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = frame.select(F.col(id).alias("id"), F.substring(body, 1, slice_bytes).alias("slice")).where(F.octet_length("slice") > 8)
    samples = [bytes(r.slice) for r in hashed_sample(rows, "warc", pages, "id", "slice").collect()]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return None


def records(frame, id="page_id", url="url", payload="html", least=100):
    """What is to be archived of each row: its record's name and type, and the payload of responses.

    Of rows with equal payloads of `least` bytes or more, that with the smallest
    identifier is the response and later ones revisit it. Rows that share the
    smallest identifier, and rows without one, are responses. A null payload is
    empty. Payloads are equal if their SHA-256 and so their names agree; the
    smallest identifier is aggregated before the shuffle, and only digests that
    occur more than once are joined back, so no payload is grouped.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = frame.select(F.col(id).alias("id"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "bytes": F.octet_length("payload").cast("long")})
    shared = rows.where((F.col("bytes") >= least) & F.col("id").isNotNull()).groupBy("digest").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("_n")
    )
    # Stored, its size is known before the join, which then moves no payload where it is small.
    marked = join_on_key(rows, store(shared.where("_n > 1").drop("_n"), "shared"), ["digest"])
    revisit = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    return marked.select(
        record_id(F.col("id"), F.col("digest")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "url",
        F.when(revisit, record_id(F.col("first"), F.col("digest"))).alias("refers_to"),
        "digest",
        "bytes",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write(frame, path, dictionary=None, archive_bytes=64 << 20, file_rows=FILE_ROWS, date="1970-01-01T00:00:00Z"):
    """Write the rows of `records` as archives below `path`, each of at most `archive_bytes` and `file_rows` rows.

    An empty table writes no archive. A single record is never divided, so one
    that is larger is an archive by itself.
    """
    if file_rows < 2:
        raise ValueError("an archive has a row for its dictionary and one for a record")
    bound_batches(frame.sparkSession)
    frames = frame.mapInArrow(_packer(dictionary, archive_bytes, file_rows, date), "frame binary")
    # A string of Spark is plain bytes to the text writer.
    text = frames.select(F.col("frame").cast("string").alias("value"))
    text.write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", file_rows).text(path)


def _packer(dictionary, archive_bytes, file_rows, date):
    columns = ("record_id", "record_type", "url", "refers_to", "digest")

    def pack(batches):
        held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        zstd = zstandard.ZstdCompressor(level=3, dict_data=held, write_checksum=True, write_content_size=True)
        lead = zstandard.ZstdCompressor(level=19).compress(dictionary) if dictionary else b""
        lead = [struct.pack("<II", DICTIONARY, len(lead)) + lead] if dictionary else []
        rows, size = 0, 0
        for block in batches:
            out, waiting = [], 0
            texts = [block.column(c).cast(pa.binary()).to_pylist() for c in columns]
            for *row, length, payload in zip(*texts, block.column("bytes").to_pylist(), block.column("payload")):
                frame = zstd.compress(_record(*row, length, payload.as_py(), date))
                if rows == file_rows:
                    rows = size = 0
                elif rows and size + len(frame) > archive_bytes:
                    out += [b""] * (file_rows - rows)
                    rows = size = 0
                new = [frame] if rows else [*lead, frame]
                rows, size = rows + len(new), size + sum(map(len, new))
                out += new
                waiting += len(frame)
                if waiting > FLUSH_BYTES:
                    yield batch("frame binary", out)
                    out, waiting = [], 0
            if out:
                yield batch("frame binary", out)

    return pack


def _record(name, kind, url, refers_to, digest, size, payload, date):
    """One record as bytes; control characters of an address are escaped, since they would end its line."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size + (payload or b"")
    lines = [b"WARC/1.1", b"WARC-Type: " + kind, b"WARC-Record-ID: " + name, b"WARC-Date: " + date.encode()]
    if url is not None:
        lines.append(b"WARC-Target-URI: " + re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], url))
    if refers_to is not None:
        lines += [b"WARC-Refers-To: " + refers_to, b"WARC-Profile: " + PROFILE.encode()]
    lines += [b"WARC-Payload-Digest: sha256:" + digest, b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def read(spark, path, payloads=True):
    """Every record of the archives below `path`, checked; one that cannot be read has a `problem`.

    A frame that cannot be decoded, or whose record has wrong headers, lengths
    or digests, is one row with a problem, and reading goes on behind it. Where
    the end of a frame cannot be told, one row stands for the rest of the
    archive. A revisit has the digest and length of the payload that it stands
    for, and no payload.
    """
    bound_batches(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def unpack(batches):
        for block in batches:
            for name, content in zip(block.column("path").to_pylist(), block.column("content")):
                rows, size = [], 0
                for row in archive(memoryview(content.as_buffer())):
                    size += len(row[8] or b"") + 512
                    rows.append((name, *row[:8], row[8] if payloads else None, row[9]))
                    if size > FLUSH_BYTES:
                        yield batch(RECORD, *zip(*rows))
                        rows, size = [], 0
                if rows:
                    yield batch(RECORD, *zip(*rows))

    return files.mapInArrow(unpack, RECORD)


def spans(data):
    """(magic, start, end) of each frame of an archive; raises where a frame is cut short or unknown."""
    at = 0
    while at < len(data):
        if len(data) - at < 8:
            raise ValueError("cut short", at)
        magic, size = struct.unpack_from("<II", data, at)
        if magic in SKIPPABLE:
            end = at + 8 + size
        elif magic == FRAME:
            end = _end(data, at)
        else:
            raise ValueError("not a frame", at)
        if end > len(data):
            raise ValueError("cut short", at)
        yield magic, at, end
        at = end


def _end(data, at):
    """Where a frame ends: its header, its blocks up to the last, its checksum."""
    try:
        form = zstandard.get_frame_parameters(data[at : at + 18])
        place = at + zstandard.frame_header_size(data[at : at + 18])
    except zstandard.ZstdError:
        raise ValueError("not a frame", at) from None
    last = False
    while not last:
        if place + 3 > len(data):
            raise ValueError("cut short", at)
        head = int.from_bytes(data[place : place + 3], "little")
        # A block of one repeated byte holds this byte alone.
        last, place = bool(head & 1), place + 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
    return place + 4 * form.has_checksum


def archive(data):
    """(offset, name, type, address, date, refers to, digest, size, payload, problem) of each record of one archive."""
    dictionary, found = None, spans(data)
    while True:
        try:
            magic, start, end = next(found)
        except StopIteration:
            return
        except ValueError as error:
            yield _failed(error.args[1], error.args[0])
            return
        if magic == DICTIONARY and start == 0:
            try:
                dictionary = _dictionary(bytes(data[8:end]))
            except ValueError as error:
                yield _failed(0, str(error))
        elif magic == FRAME:
            try:
                yield (start, *parse(_decode(data[start:end], dictionary)), None)
            except ValueError as error:
                yield _failed(start, str(error))


def _failed(offset, problem):
    return (offset, None, None, None, None, None, None, None, None, problem)


def _dictionary(held):
    """The dictionary in a leading frame, which may be compressed itself."""
    if held[:4] == struct.pack("<I", FRAME):
        held = _decode(held, None)
    if held[:4] != struct.pack("<I", RAW_DICTIONARY):
        raise ValueError("not a dictionary")
    return zstandard.ZstdCompressionDict(held)


def _decode(frame, dictionary):
    zstd = zstandard.ZstdDecompressor(dict_data=dictionary)
    try:
        if zstandard.frame_content_size(frame) >= 0:
            return zstd.decompress(frame)
        return zstd.decompressobj().decompress(frame)
    except zstandard.ZstdError as error:
        raise ValueError(f"cannot be decoded: {error}") from None


def parse(record):
    """(name, type, address, date, refers to, digest, size, payload) of a record; raises where headers or lengths are wrong."""
    head, found, rest = record.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not found or version not in (b"WARC/1.0", b"WARC/1.1"):
        raise ValueError("no record")
    fields = _fields(lines)
    for name in MANDATORY:
        if not fields.get(name):
            raise ValueError(f"no {name}")
    size = fields["content-length"]
    if not re.fullmatch("[0-9]+", size) or int(size) + 4 != len(rest) or rest[-4:] != b"\r\n\r\n":
        raise ValueError("wrong content-length")
    kind, block = fields["warc-type"], rest[:-4]
    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
    payload, stated = block, None
    if kind in ("response", "revisit") and fields.get("content-type", "").startswith("application/http"):
        http, found, payload = block.partition(b"\r\n\r\n")
        if not found or not http.startswith(b"HTTP/"):
            raise ValueError("no response")
        stated = _fields(http.partition(b"\r\n")[2]).get("content-length")
        if stated is not None and not re.fullmatch("[0-9]+", stated):
            raise ValueError("wrong length of the payload")
    if kind == "revisit":
        if payload or not digest or not fields.get("warc-refers-to"):
            raise ValueError("wrong revisit")
        length, payload = (None if stated is None else int(stated)), None
    else:
        length, own = len(payload), hashlib.sha256(payload).hexdigest()
        if stated is not None and int(stated) != length:
            raise ValueError("wrong length of the payload")
        if digest and re.fullmatch("[0-9a-f]{64}", digest) and digest != own:
            raise ValueError("wrong digest")
        digest = digest or own
    return fields["warc-record-id"], kind, fields.get("warc-target-uri"), fields["warc-date"], fields.get("warc-refers-to"), digest, length, payload


def _fields(lines):
    """Header lines as a dictionary of lower-case names; raises on a line without a name and on a name that comes twice."""
    out = {}
    for line in lines.split(b"\r\n") if lines else []:
        name, found, value = line.partition(b":")
        name = name.strip().lower().decode("utf-8", "replace")
        if not found or not name or name in out:
            raise ValueError("wrong headers")
        out[name] = value.strip().decode("utf-8", "replace")
    return out


def resolved(rows):
    """The rows of `read`, with the payload of its response for each revisit; a revisit of a record that is not there, or that differs, gets a problem."""
    own = rows.where("record_type = 'response' AND problem IS NULL")
    known = own.groupBy(F.col("record_id").alias("refers_to")).agg(
        F.min_by(F.struct("payload_digest", "payload_bytes", "payload"), "offset").alias("_seen")
    )
    joined = join_on_key(rows, known, ["refers_to"])
    differs = F.col("_seen").isNull() | (F.col("_seen.payload_digest") != F.col("payload_digest")) | (F.col("_seen.payload_bytes") != F.col("payload_bytes"))
    revisit = F.col("record_type") == "revisit"
    return joined.withColumns(
        {
            "problem": F.when(revisit & differs, F.coalesce("problem", F.lit("revisits what is not there"))).otherwise(F.col("problem")),
            "payload": F.when(revisit & ~differs, F.col("_seen.payload")).otherwise(F.col("payload")),
        }
    ).drop("_seen")


def round_trip(frame, path, id="page_id", url="url", payload="html", least=100, archive_bytes=64 << 20, file_rows=FILE_ROWS):
    """Archive a table below `path` and read it back: what the records say of each row.

    One row per row of `frame`, whatever else its columns hold; an empty table
    gives none. A record that does not read back as it was written fails the job.
    """
    kind = frame.schema[id].dataType
    write(records(frame, id, url, payload, least), path, train(frame, id, payload), archive_bytes, file_rows)
    # Without payloads the records are small; stored, the archives are read once.
    rows = resolved(store(read(frame.sparkSession, path, payloads=False), "records"))
    wrong = F.raise_error(F.concat("archive", F.lit(": "), "problem")).cast("string")
    return rows.select(
        row_id(F.col("record_id"), kind).alias(id),
        "payload_bytes",
        F.when(F.col("problem").isNotNull(), wrong).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        row_id(F.col("refers_to"), kind).alias("refers_to"),
    )
