"""Repeated byte strings by suffix arrays, built by linear grouping."""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from tidegrid.llm.support import batch, id_and_text
from tidegrid.session import store

SEED = np.uint64(0x9E3779B97F4A7C15)
PLACE = 24  # bits of a position in a packed minimum: blocks are shorter than 2 ** PLACE


def _mix(h):
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def gram_hashes(data, k):
    """A 64-bit hash of the k bytes from each position, by joining hashes of halves."""
    power, size, base = _mix(data.astype(np.uint64) + SEED), 1, 0xD6E8FEB86659FD93
    whole, done = None, 0
    while True:
        if k & size:
            if whole is None:
                whole, done = power, size
            else:
                # The part joined so far stands behind `size` bytes more in front.
                n = len(data) - done - size + 1
                if n <= 0:
                    return np.zeros(0, np.uint64)
                whole = power[:n] * np.uint64(pow(base, done, 2**64)) + whole[size : size + n]
                done += size
        if size * 2 > k:
            return whole
        n = len(power) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        power = power[:n] * np.uint64(pow(base, size, 2**64)) + power[size : size + n]
        size *= 2


def anchors(data, begins, ends, length, k):
    """Where each document can meet others: the k-gram of smallest hash in every `length` bytes.

    `data` holds the documents one after the other. Returns, for each anchor,
    its position, the first and the last start of the strings whose smallest
    k-gram it is (the leftmost, if equal), and its document. Equal strings have
    equal anchors.
    """
    none = np.zeros(0, np.int64)
    sizes = np.maximum(ends - begins - length + 1, 0)
    if not sizes.sum():
        return none, none, none, none, np.zeros(0, np.uint64)
    hashes = _mix(gram_hashes(data, k))
    low = np.uint64(2**PLACE - 1)
    packed = hashes & ~low | np.arange(len(hashes), dtype=np.uint64)
    width, have = length - k + 1, 1
    least = packed
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    document = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.arange(len(document)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begins[document]
    place = (least[starts] & low).astype(np.int64)
    new = np.append(True, (place[1:] != place[:-1]) | (document[1:] != document[:-1]))
    first = np.nonzero(new)[0]
    last = np.append(first[1:], len(starts)) - 1
    return place[first], starts[first], starts[last], document[first], hashes[place[first]]


def suffix_array(text):
    """Starts of the suffixes of a sequence of numbers, in order.

    Suffixes are grouped by a prefix that ends as their longest Lyndon prefix.
    Groups are taken from the highest down: each suffix of a group finds the
    nearest one before it in a lower group, and that one's prefix grows by the
    group's, so it moves to a new group right above its own (further up, the
    more of the group point to it). When all groups are taken, a suffix is
    ordered within its group by what follows its prefix, which is a smaller
    suffix: one pass over the finished order puts every suffix in its place.
    """
    n = len(text)
    if not n:
        return []
    values = np.asarray(text)
    by_value = np.argsort(values, kind="stable")
    new = np.append(0, np.nonzero(np.diff(values[by_value]))[0] + 1)
    members = [part.tolist() for part in np.split(by_value, new[1:])]
    number = np.zeros(n, np.int64)
    number[by_value] = np.repeat(np.arange(len(new)), np.diff(np.append(new, n)))
    group = number.tolist()
    length = [1] * len(members)
    below = list(range(-1, len(members) - 1))
    above = [*range(1, len(members)), -1]
    # The last byte, which -1 points to, is never set: it ends the search for what is not taken.
    taken, before = bytearray(n + 1), [-1] * n

    def move(moved, old, count):
        """Put suffixes that now share a longer prefix into a group right above their old one."""
        made = len(members)
        for j in moved:
            group[j] = made
        members.append(moved)
        length.append(length[old] + count * length[now])
        up = above[old]
        below.append(old)
        above.append(up)
        above[old] = made
        if up >= 0:
            below[up] = made

    now = len(members) - 1
    while now >= 0:
        here = members[now]
        if len(here) > 1:
            here = members[now] = [i for i in here if group[i] == now]
            here.sort()
        if len(here) == 1:
            i = here[0]
            if group[i] == now:
                j = i - 1
                while taken[j]:
                    j = before[j]
                before[i] = j
                taken[i] = 1
                if j >= 0:
                    old = group[j]
                    if len(members[old]) == 1:
                        length[old] += length[now]
                    else:
                        move([j], old, 1)
        elif here:
            counts = {}
            for i in here:
                j = i - 1
                while taken[j]:
                    j = before[j]
                before[i] = j
                taken[i] = 1
                if j >= 0:
                    counts[j] = counts.get(j, 0) + 1
            moves = {}
            if len(counts) == len(here):
                for j in counts:
                    old = group[j]
                    if old in moves:
                        moves[old].append(j)
                    else:
                        moves[old] = [j]
                for old in sorted(moves, reverse=True):
                    move(moves[old], old, 1)
            else:
                for j, count in counts.items():
                    key = count, group[j]
                    if key in moves:
                        moves[key].append(j)
                    else:
                        moves[key] = [j]
                for count, old in sorted(moves, reverse=True):
                    move(moves[count, old], old, count)
        now = below[now]
    # Where each group begins in ascending order, and which suffixes follow on which.
    place = [0] * len(members)
    at, now = 0, 0
    while now >= 0:
        place[now] = at
        held = members[now]
        if held and group[held[0]] == now:
            at += len(held)
        now = above[now]
    groups = np.array(group)
    following = np.arange(n) + np.array(length)[groups]
    by_next = np.argsort(following, kind="stable")
    ends = np.searchsorted(following[by_next], np.arange(n + 1), side="right").tolist()
    starts = [0, *ends[:-1]]
    by_next = by_next.tolist()
    order = [-1] * n
    for rank in range(-1, n):
        k = n if rank < 0 else order[rank]
        a, b = starts[k], ends[k]
        if a == b:
            continue
        for i in by_next[a:b]:
            g = group[i]
            at = place[g]
            order[at] = i
            place[g] = at + 1
    return order


BLOCK = 2_000_000  # bytes of text whose anchors are found at once
BUCKET = 8_000_000  # bytes of text for each bucket of anchors
ARRAY = 150_000  # bytes of one suffix array

PACKED = "bucket int, known int, open int, done int, hashes binary, places binary"
FOUND = "id long, low long, high long, at long, open boolean"


def _pieces(ids, texts, length):
    """Blocks of (row, offset, bytes); a long text is cut so that each of its strings lies in one piece."""
    block, size = [], 0
    for row, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - length + 1), BLOCK):
            piece = text[offset : offset + BLOCK + length - 1]
            if size and size + len(piece) > BLOCK:
                yield block
                block, size = [], 0
            block.append((row, offset, piece))
            size += len(piece)
    if block:
        yield block


def _six(values):
    """The low six bytes of each number."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _eight(body):
    out = np.zeros((len(body) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(body, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _planes(*columns):
    """Whole numbers as bytes, compressed; the lowest bytes of a column stand first, since the highest are alike."""
    return pa.compress(b"".join(c.view(np.uint8).reshape(-1, c.itemsize).T.tobytes() for c in columns), "zstd", asbytes=True)


def _columns(body, *forms):
    """The columns of `_planes`, whose types and lengths are given."""
    widths = [np.dtype(kind).itemsize for kind, _ in forms]
    size = sum(width * count for width, (_, count) in zip(widths, forms))
    data, at, out = np.frombuffer(pa.decompress(body, size, "zstd"), np.uint8), 0, []
    for width, (kind, count) in zip(widths, forms):
        planes = data[at : at + width * count].reshape(width, count)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += width * count
    return out


def _steps(values, kind):
    """Each number less the one before; sums of these, which may wrap around, give the numbers back."""
    return np.diff(values, prepend=values.dtype.type(0)).astype(kind)


def _packed(ids, length, gram, buckets, block):
    """The anchors of a block by bucket, equal contexts already combined: only the smallest document stays open."""
    texts = [piece for _, _, piece in block]
    data = b"".join(texts)
    ends = np.cumsum([len(t) for t in texts])
    begins = ends - [len(t) for t in texts]
    place, first, last, piece, grams = anchors(np.frombuffer(data, np.uint8), begins, ends, length, gram)
    if not len(place):
        return
    digest = xxhash.xxh3_64_intdigest
    contexts = np.array([digest(data[a:b]) for a, b in zip(first.tolist(), (last + length).tolist())], np.uint64)
    rows = np.array([row for row, _, _ in block])[piece]
    low = first - begins[piece] + np.array([offset for _, offset, _ in block])[piece]
    span, offset = (last - first).astype(np.uint8), (place - first).astype(np.uint8)
    owner = ids[rows]
    order = np.lexsort((owner, contexts, grams))
    new = np.append(True, (grams[order][1:] != grams[order][:-1]) | (contexts[order][1:] != contexts[order][:-1]))
    least = np.empty(len(order), np.int64)
    least[order] = owner[order][new][np.cumsum(new) - 1]
    is_open = owner == least
    bucket = (grams >> np.uint64(40)).astype(np.int64) % buckets
    known, number = np.unique(owner, return_inverse=True)
    by = np.argsort(bucket, kind="stable")
    cuts = np.nonzero(np.diff(bucket[by]))[0] + 1
    out = []
    for part in np.split(by, cuts):
        a, d = part[is_open[part]], part[~is_open[part]]
        used, back = np.unique(number[part], return_inverse=True)
        a_owner, d_owner = back[is_open[part]], back[~is_open[part]]
        hashes = _six(grams[a]) + _six(contexts[a])
        opened = _steps(a_owner, "<i4"), low[a].astype("<u4"), span[a], offset[a]
        places = _planes(_steps(known[used], "<i8"), *opened, _steps(d_owner, "<i4"), low[d].astype("<u4"), span[d])
        out.append((int(bucket[part[0]]), len(used), len(a), len(d), hashes, places))
    yield batch(PACKED, *zip(*out))


def _find_anchors(length, gram, buckets):
    def run(batches):
        for rows in batches:
            ids = rows.column(0).to_numpy()
            texts = rows.column(1).cast(pa.binary()).to_pylist()
            for block in _pieces(ids, texts, length):
                yield from _packed(ids, length, gram, buckets, block)

    return run


def _meet(rows):
    """What one bucket settles: strings that repeat a smaller document's whole context are removed; contexts that differ around equal anchors stay open."""
    done, parts = [], []
    for row in rows:
        count, rest = row["open"], row["done"]
        opened = ("<i4", count), ("<u4", count), ("u1", count), ("u1", count)
        ids, owner, low, span, offset, d_owner, d_low, d_span = _columns(
            row["places"], ("<i8", row["known"]), *opened, ("<i4", rest), ("<u4", rest), ("u1", rest)
        )
        ids = np.cumsum(ids)
        if count:
            low, hashes = low.astype(np.int64), _eight(row["hashes"])
            parts.append((hashes[:count], hashes[count:], ids[np.cumsum(owner)], low, low + span, low + offset))
        if rest:
            d_low = d_low.astype(np.int64)
            done.append((ids[np.cumsum(d_owner)], d_low, d_low + d_span, d_low))
    is_open = [np.zeros(sum(len(d[0]) for d in done), bool)]
    if parts:
        gram, context, owner, low, high, at = [np.concatenate(c) for c in zip(*parts)]
        order = np.lexsort((owner, context, gram))
        gram, context, owner, low, high, at = [c[order] for c in (gram, context, owner, low, high, at)]
        new = np.append(True, gram[1:] != gram[:-1])
        inner = new | np.append(True, context[1:] != context[:-1])
        group, subgroup = np.cumsum(new) - 1, np.cumsum(inner) - 1
        smallest = np.minimum.reduceat(owner, np.nonzero(new)[0])[group]
        largest = np.maximum.reduceat(owner, np.nonzero(new)[0])[group]
        contexts = np.add.reduceat(inner.astype(np.int64), np.nonzero(new)[0])[group]
        least = owner[np.nonzero(inner)[0]][subgroup]
        removed = owner > least
        waits = ~removed & (contexts > 1) & (smallest != largest)
        take = removed | waits
        done.append((owner[take], low[take], high[take], at[take]))
        is_open.append(waits[take])
    if not done:
        return None
    return batch(FOUND, *[np.concatenate(c) for c in zip(*done)], np.concatenate(is_open))


def _settle(batches):
    """Rows of a bucket stand together; each bucket is settled when its last row has been read."""
    now, held = None, []
    for rows in batches:
        for row in rows.to_pylist():
            if row["bucket"] != now:
                if held and (found := _meet(held)) is not None:
                    yield found
                now, held = row["bucket"], []
            held.append(row)
    if held and (found := _meet(held)) is not None:
        yield found


CONTEXTS = "key long, id long, low long, at long, body binary"
CLASS = 4  # neighbouring starts that are looked at together


def _places(column):
    """Where the places of each row end in one list of all, and the fields of that list; a null row has none."""
    counts = column.value_lengths().fill_null(0).to_numpy()
    return np.cumsum(counts, dtype=np.int64), [part.to_numpy() for part in column.flatten().flatten()]


def _contexts(length, gram):
    """The bytes around open anchors, in two halves by where the anchor lies; a half's key is what all its strings hold."""
    middle = (length - gram) // 2

    def halves(text, low, high, at):
        if low <= at - middle:
            yield low, min(high, at - middle), b"l" + text[at - middle : at + gram]
        if high > at - middle:
            begin = max(low, at - middle + 1)
            yield begin, high, b"r" + text[at : at - middle + 1 + length]

    def run(batches):
        for rows in batches:
            out, ends, places = [], *_places(rows.column(2))
            places = list(zip(*[p.tolist() for p in places]))
            begin = 0
            for id, body, end in zip(rows.column(0).to_pylist(), rows.column(1).cast(pa.binary()).to_pylist(), ends.tolist()):
                for low, high, at in places[begin:end]:
                    if high + length > len(body):
                        continue
                    for first, last, key in halves(body, low, high, at):
                        out.append((xxhash.xxh3_64_intdigest(key) - 2**63, id, first, at, body[first : last + length]))
                begin = end
                if len(out) > 20_000:
                    yield batch(CONTEXTS, *zip(*out))
                    out = []
            if out:
                yield batch(CONTEXTS, *zip(*out))

    return run


def repeated(contexts, length):
    """Starts whose string of `length` bytes also stands in a smaller document: (id, start) of (id, low, body) contexts, by a suffix array."""
    ids, lows, bodies = zip(*contexts) if contexts else ((), (), ())
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
    # One number below all bytes ends each body.
    ends = np.cumsum(sizes + 1) - 1
    data = np.frombuffer(b"".join(body + b"\0" for body in bodies), np.uint8)
    text = data.astype(np.int16)
    text[ends] = -1
    begins = np.repeat(ends - sizes, sizes + 1)
    place = np.arange(len(text)) - begins
    order = np.array(suffix_array(text), np.int64)
    order = order[(place <= np.repeat(sizes - length, sizes + 1))[order]]
    if not len(order):
        return []
    strings = np.lib.stride_tricks.sliding_window_view(data, length)[order]
    firsts = np.nonzero(np.append(True, (strings[1:] != strings[:-1]).any(1)))[0]
    owner = np.repeat(np.array(ids, np.int64), sizes + 1)[order]
    least = np.repeat(np.minimum.reduceat(owner, firsts), np.diff(np.append(firsts, len(order))))
    start = (place + np.repeat(np.array(lows, np.int64), sizes + 1))[order]
    return list(zip(owner[owner > least].tolist(), start[owner > least].tolist()))


def _joined(pairs):
    """(id, low, high) of the runs of neighbouring starts among (id, start) pairs."""
    if not pairs:
        return []
    ids, starts = np.array(pairs, np.int64).T
    order = np.lexsort((starts, ids))
    ids, starts = ids[order], starts[order]
    new = np.append(True, (ids[1:] != ids[:-1]) | (starts[1:] > starts[:-1] + 1))
    last = np.append(new[1:], True)
    return list(zip(ids[new].tolist(), starts[new].tolist(), starts[last].tolist()))


def _blocks_of(run, length):
    """The contexts of one key, by rising identifier, in parts no longer than one suffix array that bring equal strings together.

    A longer run is cut into its strings, which are dealt by a hash. Where a
    string has so many copies that its part is too long, each piece of that
    part begins with the first copy of every string, which is of the smallest
    document, so each of the others meets it.
    """
    size = sum(len(body) for _, _, body in run)
    if size <= ARRAY:
        return [run]
    room = max(2, ARRAY // (length + 1))
    parts = [[] for _ in range(4 * -(-size // room))]
    for id, low, body in run:
        for i in range(len(body) - length + 1):
            string = body[i : i + length]
            parts[xxhash.xxh3_64_intdigest(string) % len(parts)].append((id, low + i, string))
    out = []
    for part in parts:
        if len(part) <= room:
            out.append(part)
            continue
        firsts, others = {}, []
        for row in part:
            if firsts.setdefault(row[2], row) is not row:
                others.append(row)
        step = max(1, room - len(firsts))
        out.extend([*firsts.values(), *others[i : i + step]] for i in range(0, len(others), step))
    return [part for part in out if part]


def _combined(run, length):
    """Contexts of one key, by rising identifier: those equal to one of a smaller document are settled, and one of each kind is left."""
    least, settled, left = {}, [], []
    for id, low, at, body in run:
        if least.setdefault(body, id) < id:
            settled.append((id, low, low + len(body) - length))
        else:
            left.append((id, low, at, body))
    return settled, left if len(least) > 1 else []


def _shared(run, length):
    """The parts of contexts that hold starts which another document may share.

    Starts are looked at by classes of a few, counted from the anchor; all
    strings of a class hold the bytes from its last start to the end of its
    first string. Where no other document has those, the class is left out.
    """
    owners, classes = {}, []
    for n, (id, low, at, body) in enumerate(run):
        high = low + len(body) - length
        for c in range((at - high) // CLASS, (at - low) // CLASS + 1):
            last, first = at - c * CLASS, at - c * CLASS - CLASS + 1
            core = c, body[last - low : first + length - low]
            seen = owners.setdefault(core, id)
            if seen is not None and seen != id:
                owners[core] = None
            classes.append((n, c, core))
    out, open_part = [], None
    for n, c, core in classes:
        if owners[core] is not None:
            continue
        id, low, at, body = run[n]
        begin, end = max(low, at - c * CLASS - CLASS + 1), min(low + len(body) - length, at - c * CLASS)
        if open_part and open_part[0] == n and open_part[1] == end + 1:
            open_part[1] = begin
        else:
            open_part = [n, begin, end]
            out.append(open_part)
    return [(run[n][0], begin, run[n][3][begin - run[n][1] : end + length - run[n][1]]) for n, begin, end in out]


def _sort(length):
    schema = "id long, low long, high long"

    def run(batches):
        key, current, ready, size = None, [], [], 0
        found = []

        def close():
            nonlocal size, ready
            settled, left = _combined(current, length)
            found.extend(settled)
            for part in _blocks_of(_shared(left, length), length) if left else ():
                ready.extend(part)
                size += sum(len(c[2]) for c in part)
                if size >= ARRAY // 2:
                    found.extend(_joined(repeated(ready, length)))
                    ready, size = [], 0

        for rows in batches:
            columns = [rows.column(i).to_pylist() for i in range(5)]
            for now, id, low, at, body in zip(*columns):
                if now != key:
                    close()
                    key, current = now, []
                current.append((id, low, at, body))
            if len(found) > 20_000:
                yield batch(schema, *zip(*found))
                found.clear()
        close()
        found.extend(_joined(repeated(ready, length)))
        if found:
            yield batch(schema, *zip(*found))

    return run, schema


KEPT = "id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _cut_out(length, digest):
    schema = KEPT.replace("kept binary", "kept_sha256 string") if digest else KEPT

    def run(batches):
        for rows in batches:
            if not rows.num_rows:
                continue
            bodies = rows.column(1).cast(pa.binary()).to_pylist()
            sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
            ends, (low, high) = _places(rows.column(2))
            row = np.repeat(np.arange(len(bodies)), np.diff(ends, prepend=0))
            # All texts stand on one line, with room between them.
            shift = np.cumsum(sizes + 2) - sizes
            low, high = np.minimum(low, sizes[row]) + shift[row], np.minimum(high + length, sizes[row]) + shift[row]
            order = np.argsort(low, kind="stable")
            order = order[low[order] < high[order]]
            low, high = low[order], np.maximum.accumulate(high[order])
            new = np.append(True, low[1:] > high[:-1])[: len(low)]
            row, low, high = row[order][new], low[new], high[np.append(new[1:], True)[: len(low)]]
            low, high = low - shift[row], high - shift[row]
            spans = np.bincount(row, minlength=len(bodies))
            removed = np.bincount(row, high - low, len(bodies)).astype(np.int64)
            runs, begin, out = list(zip(low.tolist(), high.tolist())), 0, []
            for body, count in zip(bodies, spans.tolist()):
                kept, end = [], 0
                for a, b in runs[begin : begin + count]:
                    kept.append(body[end:a])
                    end = b
                begin += count
                kept = b"".join([*kept, body[end:]])
                out.append(hashlib.sha256(kept).hexdigest() if digest else kept)
            yield batch(schema, rows.column(0), sizes, removed, spans, out)

    return run, schema


def remove_repeats(frame, id="doc_id", text="text", length=50, gram=20, digest=False):
    """Each text without the bytes of any `length`-byte string that also starts in a document with a smaller identifier.

    Returns the identifier, n_bytes, n_removed, n_spans (maximal removed runs)
    and the remaining bytes, `kept` (or kept_sha256). Strings are judged on the
    input and never cross documents; overlaps count. A null text is empty and
    a text shorter than `length` is left whole. Identifiers should be unique:
    rows that share one are parts of one document, and a place removed in one
    is removed in all. A row without identifier is left whole and removes
    nothing. Other columns are not read; an empty table gives none.

    Two equal strings hold the same smallest k-gram, their anchor, so documents
    meet by anchors, about one in sixteen bytes. Where the bytes around an
    anchor are equal throughout, the smaller document keeps them. Where they
    differ, the contexts are sorted in a suffix array, and the strings in a row
    of equal ones are removed from all but the smallest document.
    """
    if length - gram > 255:
        raise ValueError("a string may be at most 255 bytes longer than a gram")
    rows = id_and_text(frame, id, text).select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 8 + size // BUCKET
    known = rows.filter("id IS NOT NULL")
    packed = known.mapInArrow(_find_anchors(length, gram, buckets), PACKED)
    met = store(packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_settle, FOUND), "anchors")
    asked = met.filter("open").groupBy("id").agg(F.collect_list(F.struct("low", "high", "at")).alias("places"))
    sort, sorted_schema = _sort(length)
    around = rows.join(asked, "id", "left").mapInArrow(_contexts(length, gram), CONTEXTS)
    found = around.repartition("key").sortWithinPartitions("key", "id", "low").mapInArrow(sort, sorted_schema)
    removed = met.filter("NOT open").select("id", "low", "high").unionByName(found)
    removed = removed.groupBy("id").agg(F.collect_list(F.struct("low", "high")).alias("places"))
    run, schema = _cut_out(length, digest)
    return rows.join(removed, "id", "left").mapInArrow(run, schema).withColumnRenamed("id", id)
