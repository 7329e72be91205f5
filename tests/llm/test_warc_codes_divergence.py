"""Archives, vector codes and source divergence against brute force, and on awkward rows."""

import collections
import functools
import hashlib
import math
import random
import re
import struct

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from tidegrid.llm import codes, divergence, warc

rng = random.Random(8)


# Archives

PAGES = "page_id long, url string, html string, payload string, digest string, record_id string"


@functools.cache
def pages():
    long = "".join(rng.choice("abc <>é") for _ in range(1_500_000))
    texts = ["<p>%d</p>" % i * 30 for i in range(40)] + [long, long, None, "", "", "short", "short", "é" * 49 + "ab", "é" * 49 + "ab", "é" * 49 + "a", "é" * 49 + "a"]
    rows = [(i, f"https://h.example/{i}", t, "x", None, "y") for i, t in enumerate(texts)]
    rows += [(100 + i, "a b\r\nX: 1", "<p>7</p>" * 30, None, None, None) for i in range(25)]
    rows += [(3, None, "<p>3</p>" * 30, None, None, None), (200, None, "<p>3</p>" * 30, None, None, None), (3, "", "other" * 40, None, None, None)]
    rows += [(None, "u", "<p>3</p>" * 30, None, None, None), (None, None, "only here " * 20, None, None, None), rows[5]]
    return rows


def expected(rows):
    bodies = [(i, (t or "").encode()) for i, _, t, *_ in rows]
    least = {}
    for i, b in bodies:
        if i is not None and len(b) >= 100:
            least[b] = min(least.get(b, i), i)
    for i, b in bodies:
        first = least.get(b)
        later = i is not None and first is not None and i > first
        yield i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if later else "response", first if later else None


def by_text(rows):
    return sorted(map(tuple, rows), key=repr)


def test_archives_read_back(spark, tmp_path):
    frame = spark.createDataFrame(pages(), PAGES).repartition(3)
    found = warc.round_trip(frame, str(tmp_path / "a"), archive_bytes=400_000, file_rows=20)
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert by_text(found.collect()) == by_text(expected(pages()))
    files = list((tmp_path / "a").glob("part-*"))
    assert len(files) > 4
    # No archive is larger than asked for, but for one of a single record.
    held = [(f.stat().st_size, len(list(warc.archive(f.read_bytes())))) for f in files]
    assert all(records == 1 or size < 400_000 + 20 * 8 for size, records in held)
    assert all(records < 20 for _, records in held) and max(records for _, records in held) > 5
    texts = {(i, t or "") for i, _, t, *_ in pages()}
    whole = warc.resolved(warc.read(spark, str(tmp_path / "a")))
    assert whole.where("problem IS NOT NULL").count() == 0
    rows = whole.select(warc.row_id(F.col("record_id"), "long").alias("i"), "payload", "target_uri").collect()
    assert {(r.i, bytes(r.payload).decode()) for r in rows} == texts
    assert "a%20b%0D%0AX:%201" in {r.target_uri for r in rows}
    # Each file is a plain Zstandard stream to any other reader.
    data = files[0].read_bytes()
    magic, size = struct.unpack_from("<II", data)
    assert magic == warc.DICTIONARY
    held = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held)).stream_reader(data, read_across_frames=True)
    assert reader.read().startswith(b"WARC/1.1\r\n")


def test_archives_of_awkward_tables(spark, tmp_path):
    none = spark.createDataFrame([], PAGES)
    assert warc.round_trip(none, str(tmp_path / "none")).count() == 0
    # Identifiers of other kinds; too few pages for a dictionary.
    named = spark.createDataFrame([("a/b é", None, "x" * 200), ("a/a", None, "x" * 200), ("", None, None)], "page_id string, url string, html string")
    assert by_text(warc.round_trip(named, str(tmp_path / "n")).select("page_id", "record_type", "refers_to").collect()) == by_text(
        [("a/b é", "revisit", "a/a"), ("a/a", "response", None), ("", "response", None)]
    )
    assert warc.train(named) is None


def record(kind=b"resource", body=b"hello", size=None, extra=b"", version=b"WARC/1.0"):
    head = version + b"\r\nWARC-Type: " + kind + b"\r\nWARC-Record-ID: <urn:x>\r\nWARC-Date: 2024-01-01T00:00:00Z\r\n" + extra
    return head + b"Content-Length: %d\r\n\r\n" % (len(body) if size is None else size) + body + b"\r\n\r\n"


@pytest.mark.parametrize(
    "held, problem",
    [
        (record(), None),
        (record(size=4), "wrong content-length"),
        (record(size=6), "wrong content-length"),
        (record(extra=b"no colon\r\n"), "wrong headers"),
        (record(extra=b"warc-type: again\r\n"), "wrong headers"),
        (record(version=b"HTTP/1.1"), "no record"),
        (record().replace(b"WARC-Date: 2024-01-01T00:00:00Z\r\n", b""), "no warc-date"),
        (record(extra=b"WARC-Payload-Digest: sha256:" + b"0" * 64 + b"\r\n"), "wrong digest"),
        (record(kind=b"revisit", extra=b"WARC-Payload-Digest: sha256:00\r\n"), "wrong revisit"),
        (record(kind=b"response", body=b"HTTP/1.1 200 OK\r\nContent-Length: 9\r\n\r\nhello", extra=b"Content-Type: application/http\r\n"), "wrong length of the payload"),
        (record(kind=b"response", body=b"hello", extra=b"Content-Type: application/http\r\n"), "no response"),
        (record()[:-1], "wrong content-length"),
        (b"", "no record"),
    ],
)
def test_headers_and_lengths(held, problem):
    found = list(warc.archive(zstandard.compress(held)))
    assert [f[-1] for f in found] == [problem]
    if problem is None:
        assert found[0][1:3] == ("<urn:x>", "resource") and found[0][-2] == b"hello"


def test_frames_that_cannot_be_read():
    good = zstandard.compress(record())
    sums = zstandard.ZstdCompressor(write_checksum=True).compress(record(body=bytes(rng.choice(b"abcdef") for _ in range(9000))))
    spoiled = sums[:-1] + bytes([sums[-1] ^ 1])
    skip = warc.SEPARATOR.encode()
    whole = lambda data: [(f[0], f[-1] is None) for f in warc.archive(data)]
    assert whole(good + skip + spoiled + good) == [(0, True), (len(good) + 8, False), (len(good) + 8 + len(sums), True)]
    assert whole(good + good[:-3]) == [(0, True), (len(good), False)]
    assert whole(good + b"garbage here") == [(0, True), (len(good), False)]
    assert whole(good + skip[:6]) == [(0, True), (len(good), False)]
    assert whole(b"") == [] and whole(skip) == []
    # A frame without its length in front, in many blocks, and one of a repeated byte.
    streamed = zstandard.ZstdCompressor(write_content_size=False).compressobj()
    body = bytes(rng.randrange(256) for _ in range(400_000))
    data = streamed.compress(record(body=body)) + streamed.flush() + zstandard.compress(record(body=b"z" * 300_000))
    assert [f[-2] for f in warc.archive(data)] == [body, b"z" * 300_000]
    # A dictionary may be plain or compressed, and must be one.
    held = zstandard.train_dictionary(2000, [record(body=b"%d some words" % i * 9) for i in range(300)]).as_bytes()
    packed = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(held)).compress(record())
    lead = lambda d: struct.pack("<II", warc.DICTIONARY, len(d)) + d
    assert whole(lead(held) + packed) == [(8 + len(held), True)]
    assert [ok for _, ok in whole(lead(zstandard.compress(held)) + packed)] == [True]
    assert [ok for _, ok in whole(lead(b"nothing") + packed)] == [False, False]


def test_revisits_are_held_against_what_they_revisit(spark):
    kinds = "record_id string, record_type string, refers_to string, payload_digest string, payload_bytes long, payload binary, problem string, offset long"
    rows = [("a", "response", None, "d", 3, b"abc", None, 0), ("b", "revisit", "a", "d", 3, None, None, 1), ("c", "revisit", "a", "e", 3, None, None, 2), ("d", "revisit", "x", "d", 3, None, None, 3)]
    found = {r.record_id: (r.problem is None, r.payload) for r in warc.resolved(spark.createDataFrame(rows, kinds)).collect()}
    assert found == {"a": (True, b"abc"), "b": (True, b"abc"), "c": (False, None), "d": (False, None)}


# Vector codes

VECTORS = "vec_id long, embedding array<double>, label int, code string, error long, own int, vector string"


def brute_codes(rows, parts, entries, rounds, scale=256):
    """Every distance of every round, in whole numbers."""
    held = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    lengths = collections.Counter(len(r[1]) for r in held if len(r[1]) and len(r[1]) % parts == 0)
    length = max(lengths, key=lambda n: (lengths[n], n))
    held = [r for r in held if len(r[1]) == length]
    w = length // parts
    whole = lambda x: math.floor(x) * scale if abs(x) >= 2.0**60 else math.floor(x * scale)
    cut = [[[whole(x) for x in r[1][p * w : p * w + w]] for p in range(parts)] for r in held]
    first = sorted(range(len(held)), key=lambda i: (held[i][0] is None, held[i][0] or 0, held[i][1]))[:entries]
    books = [[cut[i][p] for i in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda: [[min((far(v[p], c), e) for e, c in enumerate(books[p])) for p in range(parts)] for v in cut]
    for _ in range(rounds):
        own = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [v[p] for v, o in zip(cut, own) if o[p][1] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    out = [(r[0], bytes(e for _, e in o).hex(), sum(d for d, _ in o), r[2]) for r, o in zip(held, assign())]
    total = collections.Counter()
    for _, _, error, label in out:
        total[label] += error
    text = ",".join(str(v) for b in books for e in b for v in e)
    fits = lambda v: v if v < 2**63 else None
    whole = {label: None if any(e >= 2**63 for _, _, e, l in out if l == label) else fits(v) for label, v in total.items()}
    return [(i, c, fits(e), whole[l]) for i, c, e, l in out], hashlib.sha256(text.encode()).hexdigest()


def vectors(n, dims, seed, spread=0.3):
    r = random.Random(seed)
    centres = [[r.uniform(-1, 1) for _ in range(dims)] for _ in range(12)]
    out = [(i, [c + r.gauss(0, spread) for c in r.choice(centres)], r.choice([1, 2, None])) for i in range(n)]
    # Ties: coarse numbers, repeated vectors and rows.
    out += [(n + i, [round(x) / 4 for x in out[i][1]], 3) for i in range(min(n, 40))] + [(2 * n + i, out[0][1], 3) for i in range(20)] + [out[1]]
    return [(*row, "c", 1, 2, "v") for row in out]


@pytest.mark.parametrize("n, dims, parts, entries, rounds, groups", [(300, 16, 4, 16, 2, 4), (200, 8, 8, 64, 3, 5), (120, 6, 2, 10, 6, 1), (30, 4, 4, 256, 2, 4)])
def test_codes(spark, n, dims, parts, entries, rounds, groups):
    rows = vectors(n, dims, n)
    found = codes.compress(spark.createDataFrame(rows, VECTORS).repartition(3), parts=parts, entries=entries, rounds=rounds, groups=groups)
    expected, books = brute_codes(rows, parts, entries, rounds)
    assert found.rows.columns == ["id", "code", "error", "label_error"]
    assert by_text(found.rows.collect()) == by_text(expected)
    assert codes.digest(found.codebooks) == books


def test_codes_of_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(60, 8, 3)
    odd = [None, [], [1.0] * 7, [1.0] * 4, [None] + [1.0] * 7, [nan] * 8, [inf] + [0.0] * 7, [0.0] * 8, [-0.0] * 8, [1e300] + [0.0] * 7, [-1e25] * 8, [1e12, 1.0] * 4, [-1e-9] * 8]
    rows += [(1000 + i, v, None, None, None, None, None) for i, v in enumerate(odd)] + [(None, [0.5] * 8, 1, None, None, None, None), (None, [0.25] * 8, 1, None, None, None, None)]
    found = codes.compress(spark.createDataFrame(rows, VECTORS).repartition(2), parts=4, entries=8)
    expected, books = brute_codes(rows, 4, 8, 2)
    assert by_text(found.rows.collect()) == by_text(expected)
    assert codes.digest(found.codebooks) == books
    none = codes.compress(spark.createDataFrame(rows[-15:-10], VECTORS))
    assert none.rows.count() == 0 and none.codebooks == []


def test_bounds_hold_and_spare_scans():
    """Each bound stays below the distances that it speaks of, and later rounds scan less."""
    r = np.random.default_rng(5)
    centres = r.integers(-200, 200, (32, 4))
    points = (centres[r.integers(0, 32, 4000)] + r.integers(-20, 20, (4000, 4))).astype(np.int64)
    own, bound, stamp = np.zeros(4000, np.uint8), np.zeros((4000, 4), np.float32), np.zeros((4000, 4), np.uint8)
    history, scanned = [[points[:32].tolist()]], []
    for place in range(8):
        before = stamp.copy()
        moved = [m[0] for m in codes._moved(history)]
        book = np.array(history[-1][0])
        far = codes.assign(points, book, place, own, bound, stamp, moved)
        exact = ((points[:, None, :] - book[None]) ** 2).sum(2)
        assert (own == exact.argmin(1)).all() and (far == exact.min(1)).all()
        others = np.sqrt(exact.astype(float))
        others[np.arange(4000), own] = np.inf
        ways = np.array([[m[g * 8 : g * 8 + 8].max() for g in range(4)] for m in moved] + [[0.0] * 4])
        for g in range(4):
            assert (bound[:, g] - ways[stamp[:, g], g] <= others[:, g * 8 : g * 8 + 8].min(1) + 1e-6).all()
        scanned.append((stamp == place).sum() if place else before.size)
        history.append([[(points[own == e].sum(0) // (own == e).sum()).tolist() if (own == e).any() else list(old) for e, old in enumerate(history[-1][0])]])
    assert scanned[-1] < scanned[0] / 2


# Divergence of sources

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, term string, ordinal long, part string, n long"


def brute_audit(rows, least, top):
    docs = [(r[2] or "", r[3] or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or ""))) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        seen = collections.Counter(t for l, _, ts in docs if l == lang for t in set(ts))
        kept = sorted((t for t, n in seen.items() if n >= least), key=str.encode)
        v = len(kept)

        def shares(of):
            held = collections.Counter(t for l, s, ts in docs if l == lang and of(s) for t in ts if seen[t] >= least)
            n = sum(held.values())
            return held, [1 + 1_000_000_000 * (held[t] + 5) // (n + 5 * v) for t in kept]

        sources = sorted({d[1] for d in docs if d[0] == lang}, key=str.encode)
        own = {s: shares(s.__eq__) for s in sources}
        q = shares(lambda s: True)[1]
        for s in sources:
            held, p = own[s]
            pairs = sorted((-sum(abs(a - b) for a, b in zip(p, own[o][1])), o.encode()) for o in sources if o != s)
            out += [(lang, s, "pair", o.decode(), -f, i) for i, (f, o) in enumerate(pairs, 1)]
            marks = sorted((b - a, t.encode()) for t, a, b in zip(kept, p, q) if held[t] and a > b)[:top]
            out += [(lang, s, "term", t.decode(), -f, i) for i, (f, t) in enumerate(marks, 1)]
    return out


@functools.cache
def documents():
    words = ["".join(rng.choice("abAB") for _ in range(rng.randint(1, 5))) for _ in range(60)] + ["é", "ÉÉ", "日本", "zz", "a" * 500]
    rows = []
    for i in range(400):
        text = "".join(rng.choice(words) + rng.choice([" ", "1", "_", "\n", "\x00", "é ", "\x7f"]) for _ in range(rng.choice([0, 1, 20, 60])))
        rows.append((i, text, rng.choice(["x", "x", "y", None, ""]), rng.choice(["s%d" % (i % 7), "é", None]), 1, "t", 5, "p", 2))
    rows += [(900 + i, None, "rare", f"r{i}", None, None, None, None, None) for i in range(4)] + [(950, "word", "alone", "only", None, None, None, None, None)]
    rows += [rows[0], rows[0], (None, "aB " * 400_000, "x", "long", None, None, None, None, None)]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"piece": 7, "round_bytes": 9000}])
def test_divergence(spark, sizes):
    rows = documents()
    found = divergence.audit(spark.createDataFrame(rows, DOCUMENTS).repartition(3), least=5, top=9, **sizes)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert by_text(found.collect()) == by_text(brute_audit(rows, 5, 9))


def test_divergence_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TERMS", 8)
    monkeypatch.setattr(divergence, "SOURCES", 3)
    rows = documents()
    found = divergence.audit(spark.createDataFrame(rows, DOCUMENTS), least=3, top=4, piece=10)
    assert by_text(found.collect()) == by_text(brute_audit(rows, 3, 4))


def test_divergence_of_nothing(spark):
    assert divergence.audit(spark.createDataFrame([], DOCUMENTS)).count() == 0
    few = divergence.audit(spark.createDataFrame(documents()[:3], DOCUMENTS))
    assert by_text(few.collect()) == by_text(brute_audit(documents()[:3], 30, 50))


def test_transducer():
    terms = sorted({bytes(rng.choice(b"abcde\xc3\xff") for _ in range(rng.randint(1, 9))) for _ in range(3000)})
    machine = divergence.opened(divergence.transducer(terms))
    assert list(divergence.spelled(machine)) == terms
    asked = terms + [t + b"a" for t in terms] + [t[:-1] for t in terms] + [b"nothing"]
    text = np.frombuffer(b"".join(t + b"\0" for t in asked), np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in asked])[:-1]])
    place = {t: i for i, t in enumerate(terms)}
    assert divergence.places(machine, text, starts).tolist() == [place.get(t, -1) for t in asked]
    # Terms that share their ends share the states of these.
    arcs, sizes = divergence.minimal([b"bing", b"king", b"ring", b"sing"])
    assert len(arcs) == 6 and sizes[-1] == 4
    accepted = {tuple(a) for a in arcs}
    assert len(accepted) == len(arcs)


def test_divergence_works_in_blocks_of_bounded_text():
    # Rows within the bound together, a longer row by itself, no row lost.
    texts = ["ab " * 10, "c " * 5, "d " * 100, "", "e "]
    held = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(texts)], names=["i", "text"])
    blocks = list(divergence._blocks([held, held.slice(0, 0), held.slice(1, 2)], 40))
    assert [b.column("i").to_pylist() for b in blocks] == [[0, 1], [2], [3, 4], [1], [2]]
