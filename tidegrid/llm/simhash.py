"""SimHash near duplicates, found through segments with one wildcard bit."""

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tidegrid.llm.support import batch, components, cut, id_and_text, raw

# Runs of one key up to this length are compared all with all; longer ones are walked through.
SHORT_RUN = 24
# A key with more fingerprints than this is divided by the bits outside its segment.
LONG_RUN = 60_000
HASHES = 250_000


def _spread(h, lane):
    """Further 64 bits of a hash: another lane of a wider fingerprint."""
    h = h + np.uint64((0x9E3779B97F4A7C15 * lane) % 2**64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text, words):
    """A text (bytes) as words with single spaces, and where its shingles start and end; None for a text without words."""
    found = text.lower().split()  # of bytes: A-Z only; space and \t\n\v\f\r part words
    if not found:
        return None
    line = b" ".join(found)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    if len(found) >= words:
        return line, starts[: len(found) - words + 1], ends[words - 1 :]
    return line, starts[:1], ends[-1:]


def hashes(line, starts, ends):
    """The 64-bit hashes of some shingles."""
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], 42) for a, b in zip(starts.tolist(), ends.tolist())], np.uint64)


def fingerprint(text, words, lanes):
    """The lanes of one text (bytes): bit i is set if it is in over half of the shingle hashes."""
    found = shingles(text, words)
    if not found:
        return np.zeros(lanes, np.uint64)
    line, starts, ends = found
    counts = np.zeros((lanes, 64), np.int64)
    for at in range(0, len(starts), HASHES):
        h = hashes(line, starts[at : at + HASHES], ends[at : at + HASHES])
        for lane in range(lanes):
            bits = np.unpackbits((_spread(h, lane) if lane else h).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts[lane] += bits.sum(0, dtype=np.int64)
    return np.packbits(counts * 2 > len(starts), axis=1, bitorder="little").view(np.uint64).ravel()


def _names(lanes):
    return [f"f{i}" for i in range(lanes)]


def _fingerprints(words, lanes, *more):
    """Of rows of an identifier, the columns `more` (longs) and the text."""
    schema = ", ".join(["id long"] + [f"{n} long" for n in [*more, *_names(lanes)]])

    def run(batches):
        for rows in batches:
            prints = [fingerprint(t, words, lanes) for t in raw(rows.column(1 + len(more)))]
            if prints:
                yield batch(schema, *rows.columns[:-1], *np.array(prints).view(np.int64).T)

    return run, schema


def fingerprints(frame, id="doc_id", text="text", words=3, lanes=1):
    """The SimHash of each text: the identifier and one long per 64 bits.

    Words are runs without ASCII white space, lower-cased in A-Z; a shingle is
    `words` of them with single spaces, repeats counted; a shorter text is one
    shingle, a text without words (or null) has zero bits.
    """
    run, schema = _fingerprints(words, lanes)
    rows = id_and_text(frame, id, text).select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, schema)


def _variants(lanes, segment):
    """Each fingerprint under each of its segments with each one bit left out."""
    per_lane = 64 // segment
    schema = ", ".join(["key long", "rep long"] + [f"{n} long" for n in _names(lanes)])

    def run(batches):
        for rows in batches:
            prints = np.column_stack([c.to_numpy() for c in rows.columns[1:]]).view(np.uint64)
            mask = np.uint64(2**segment - 1)
            for lane in range(lanes):
                for part in range(per_lane):
                    value = (prints[:, lane] >> np.uint64(part * segment)) & mask
                    for bit in range(segment):
                        tag = np.uint64((lane * per_lane + part) * segment + bit)
                        key = value & ~np.uint64(1 << bit) | tag << np.uint64(segment)
                        yield batch(schema, key.view(np.int64), rows.column(0), *prints.view(np.int64).T)

    return run, schema


def _near(one, two, distance):
    return np.bitwise_count(one ^ two).sum(-1, dtype=np.int32) <= distance


def _walk(prints, distance):
    """Links that connect what is connected among fingerprints: each one met is compared only with those not yet met."""
    links = []
    left = np.arange(len(prints))
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            near = _near(prints[left], prints[at], distance)
            for other in left[near].tolist():
                links.append((at, other))
                front.append(other)
            left = left[~near]
    return np.array(links, np.int64).reshape(-1, 2)


def _divided(prints, segment, tag, distance):
    """Links within one key of very many fingerprints, exact as `_walk`.

    All agree in one segment but for one bit, so two linked ones differ in at
    most `distance` of the other bits. Those are cut in `distance // 2 + 1`
    parts, of which one differs in at most one bit; the fingerprints are walked
    through by these parts with one bit left out.
    """
    lanes = prints.shape[1]
    lane, part = divmod(tag // segment, 64 // segment)
    bits = [(l, b) for l in range(lanes) for b in range(64) if (l, b // segment) != (lane, part)]
    links = []
    for piece in np.array_split(np.arange(len(bits)), distance // 2 + 1):
        for skipped in piece.tolist():
            masks = np.zeros(lanes, np.uint64)
            for i in piece.tolist():
                if i != skipped:
                    masks[bits[i][0]] |= np.uint64(1 << bits[i][1])
            kept = prints & masks
            order = np.lexsort(kept.T)
            cuts = np.nonzero((kept[order][1:] != kept[order][:-1]).any(1))[0] + 1
            for run in np.split(order, cuts):
                if len(run) > 1:
                    links.append(run[_walk(prints[run], distance)])
    return np.concatenate(links) if links else np.zeros((0, 2), np.int64)


def links_of_runs(keys, prints, segment, distance):
    """Links within runs of equal keys, enough to connect what is connected."""
    out = []
    cuts = np.append(0, np.nonzero(keys[1:] != keys[:-1])[0] + 1)
    sizes = np.diff(np.append(cuts, len(keys)))
    short = np.repeat(sizes <= SHORT_RUN, sizes)
    for step in range(1, min(SHORT_RUN, int(sizes.max(initial=0)))):
        at = np.nonzero((keys[step:] == keys[:-step]) & short[step:])[0]
        if not len(at):
            break
        at = at[_near(prints[at], prints[at + step], distance)]
        out.append(np.column_stack([at, at + step]))
    for begin, size in zip(cuts[sizes > SHORT_RUN].tolist(), sizes[sizes > SHORT_RUN].tolist()):
        run = prints[begin : begin + size]
        tag = int(keys[begin]) >> segment
        out.append(begin + (_walk(run, distance) if size <= LONG_RUN else _divided(run, segment, tag, distance)))
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def _links(lanes, segment, distance):
    schema = "u long, v long"

    def emit(table):
        pairs = links_of_runs(table[:, 0], table[:, 2:].view(np.uint64), segment, distance)
        # The same two meet under many keys; each pair leaves a block once.
        ends = np.sort(table[:, 1][pairs], axis=1)
        return batch(schema, *np.unique(ends, axis=0).T)

    def run(batches):
        table, held, size = np.zeros((0, lanes + 2), np.int64), [], 0
        for rows in batches:
            held.append(np.column_stack([c.to_numpy() for c in rows.columns]))
            size += rows.num_rows
            if size >= 200_000:
                table, held, size = np.concatenate([table, *held]), [], 0
                # The last key may go on in the next batch.
                end = int(np.searchsorted(table[:, 0], table[-1, 0]))
                if end:
                    yield emit(table[:end])
                    table = table[end:]
        table = np.concatenate([table, *held])
        if len(table):
            yield emit(table)

    return run, schema


def links(prints, lanes=1, segment=32, distance=3):
    """Links (u, v) between the rows of distinct fingerprints (rep, f0, ...), enough to connect all that chains of links connect.

    A link is a difference of `distance` or fewer bits. There are 64 * lanes /
    segment segments; while the distance is below twice that number, one
    segment of two linked fingerprints differs in at most one bit, so they
    agree in that segment with one bit left out. Such variants are partitioned
    by value and sorted, and each run is verified on the whole fingerprints.
    """
    run, schema = _variants(lanes, segment)
    verify, out = _links(lanes, segment, distance)
    variants = prints.select("rep", *_names(lanes)).mapInArrow(run, schema)
    return variants.repartition("key").sortWithinPartitions("key").mapInArrow(verify, out)


def groups(frame, id="doc_id", text="text", words=3, lanes=1, segment=32, distance=3):
    """The fingerprint of each row and the component it is linked into.

    One row per row of the frame: the identifier, fingerprint (16 hexadecimal
    digits per lane) and component_id, the smallest identifier that links of
    `distance` or fewer differing bits reach, itself included. See
    `fingerprints` for null, empty and short texts; all without words share
    the zero fingerprint and are linked like others. Rows without identifier
    take the component of their fingerprint, which is null if no row of that
    fingerprint has one. Other columns are not read; an empty table gives none.
    """
    names = _names(lanes)
    prints = cut(fingerprints(frame, id, text, words, lanes))
    distinct = cut(prints.groupBy(*names).agg(F.min("id").alias("rep")).filter("rep IS NOT NULL"))
    found = components(links(distinct, lanes, segment, distance))
    classes = distinct.join(found, distinct.rep == found.node, "left").select(*names, F.coalesce("least", "rep").alias("component_id"))
    return prints.join(classes, names, "left").select(
        F.col("id").alias(id),
        F.concat(*[F.lpad(F.lower(F.hex(n)), 16, "0") for n in names]).alias("fingerprint"),
        "component_id",
    )


def dedup(frame, id="doc_id", text="text", words=3, lanes=1, segment=32, distance=3):
    """The rows of the frame without those whose component has a smaller identifier; all columns stay, and rows without identifier stay.

    Components are those of `groups`, but of texts: another text under the
    same identifier is a node of its own, and goes only by its own links.
    """
    names = _names(lanes)
    run, schema = _fingerprints(words, lanes, "mark")
    mark = F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))
    rows = frame.filter(F.col(id).isNotNull()).select(F.col(id).cast("long").alias("id"), mark.alias("mark"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    prints = cut(rows.mapInArrow(run, schema))
    distinct = cut(prints.groupBy(*names).agg(F.min("id").alias("own")).withColumn("rep", F.xxhash64(*names) if lanes > 1 else F.col("f0")))
    found = components(links(distinct, lanes, segment, distance))
    classes = distinct.join(found, distinct.rep == found.node, "left").select(*names, "own", F.coalesce("least", "rep").alias("part"))
    smallest = classes.groupBy("part").agg(F.min("own").alias("component_id"))
    judged = prints.join(classes.drop("own"), names).join(smallest, "part")
    dropped = judged.filter("id <> component_id").select(F.col("id").alias("_gone_id"), F.col("mark").alias("_gone_mark")).distinct()
    own = F.xxhash64(F.coalesce(frame[text].cast("string"), F.lit("")))
    return frame.join(dropped, (frame[id].cast("long") == dropped["_gone_id"]) & (own == dropped["_gone_mark"]), "left_anti")
