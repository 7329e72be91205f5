"""Removal of repeated passages by sliding spans of sentences."""

import hashlib
import re
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegrid.llm.support import batch, id_and_text, ragged

BOUND = re.compile(r"[.!?]++(?=\s)|\n")
WORD = re.compile(r"\S+")
LONGEST = 16  # words of a sentence; a longer one is cut
REACH = 3  # words to each side among which a cut has the smallest hash
MIX = 0x9E3779B97F4A7C15
BITS = 2**64 - 1
SPACE = np.array([chr(i).isspace() for i in range(2**16)])
STOP = np.array([chr(i) in ".!?" for i in range(2**16)])
BASE = 0xD6E8FEB86659FD93  # odd, so that it has an inverse among numbers of 64 bits
GROUP = 2**20  # characters of the texts that are cut at once; a longer text is cut alone


@cache
def _powers(size):
    """BASE to the powers from 0, and its inverse to the same powers."""
    one = np.ones(1, np.uint64)
    return [np.append(one, np.full(size - 1, base, np.uint64)).cumprod(dtype=np.uint64) for base in (BASE, pow(BASE, -1, 2**64))]


def _points(text):
    """The code points of a text."""
    try:
        return np.frombuffer(text.encode("latin-1"), np.uint8)
    except UnicodeEncodeError:
        return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _small(points):
    """Code points as indices of SPACE and STOP; none of those beyond 16 bits is a space or a stop."""
    return points if points.dtype == np.uint8 else np.minimum(points, 2**16 - 1)


def _word_edges(space):
    """Where words start and end."""
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    return edge[::2], edge[1::2]


def _word_hashes(points, starts, ends):
    """A 64-bit hash of each word: its characters as digits to BASE, by running sums over pieces of the text."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + GROUP, "right")))
        begin, stop = int(starts[first]), int(ends[last - 1])
        up, down = _powers(1 << max(20, (stop - begin).bit_length()))
        sums = np.zeros(stop - begin + 1, np.uint64)
        np.cumsum((points[begin:stop].astype(np.uint64) + np.uint64(1)) * up[: stop - begin], out=sums[1:])
        a, b = starts[first:last] - begin, ends[first:last] - begin
        value = (sums[b] - sums[a]) * down[a]
        out[first:last] = (value ^ (value >> np.uint64(29))) * np.uint64(MIX)
        first = last
    return out


def cuts(words):
    """Where a long sentence is cut: before words that, with the word ahead, have the smallest hash within REACH words.

    So equal passages are cut alike wherever they start. Between two such cuts
    further apart than LONGEST words it is cut each LONGEST words. `Group`
    does the same for all sentences of many texts at once.
    """
    points = _points(" ".join(words))
    codes = _word_hashes(points, *_word_edges(SPACE.take(_small(points)))).tolist()
    values = [((a * MIX & BITS) ^ b) * MIX & BITS for a, b in zip(codes, codes[1:])]
    out = [0]
    for i, value in enumerate(values):
        begin = i - REACH if i > REACH else 0
        if value == min(values[begin : i + REACH + 1]) and value not in values[begin:i]:
            out.extend(range(out[-1] + LONGEST, i + 1, LONGEST))
            out.append(i + 1)
    out.extend(range(out[-1] + LONGEST, len(words), LONGEST))
    return out


def sentences(text):
    """(start, end, words) of each sentence: it ends behind . ! ? before white space or at a line's end; one of over 16 words is cut by content."""
    out, begin = [], 0
    for end in [m.end() for m in BOUND.finditer(text)] + [len(text)]:
        words = text[begin:end].lower().split()
        if len(words) <= LONGEST:
            if words:
                out.append((begin, end, words))
        else:
            marks = [m.start() for m in WORD.finditer(text, begin, end)]
            at = cuts(words)
            for i, j in zip(at, at[1:] + [len(words)]):
                stop = marks[j] if j < len(words) else end
                out.append((begin if i == 0 else marks[i], stop, words[i:j]))
        begin = end
    return out


def spans(found, run, words):
    """(first, last, hash) of each run of at least `run` sentences that has at least `words` words."""
    sizes = [len(w) for _, _, w in found]
    texts = [" ".join(w) for _, _, w in found]
    last, total = 0, 0
    out = []
    for first in range(len(found)):
        while last < len(found) and (last < first + run or total < words):
            total += sizes[last]
            last += 1
        if last - first < run or total < words:
            break
        out.append((first, last, xxhash.xxh3_128_intdigest("\n".join(texts[first:last]))))
        total -= sizes[first]
    return out


def _content_cuts(codes, place, sizes):
    """Whether the long sentences of a text are cut behind each word but the last; place is the sentence of each word."""
    values = ((codes[:-1] * np.uint64(MIX)) ^ codes[1:]) * np.uint64(MIX)
    cut = (place[1:] == place[:-1]) & (sizes[place[1:]] > LONGEST)
    for step in range(1, min(REACH, len(values) - 1) + 1):
        cut[step:] &= (values[step:] < values[:-step]) | (place[:-step - 1] != place[step:-1])
        cut[:-step] &= (values[:-step] <= values[step:]) | (place[step + 1 :] != place[: -step - 1])
    return cut


class Group:
    """The sentences of several texts, cut at once as `sentences` cuts each, and their spans.

    `starts` and `stops` are places in the joined texts; `text_of` is the text
    of each sentence, `low` and `high` its first sentence and the one behind
    its last. `lasts` is the sentence behind the span that starts at each
    sentence, `valid` where this span lies in the text.
    """

    def __init__(self, texts, run, words):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.begins = np.cumsum(sizes + 1) - sizes - 1
        joined = "\n".join(texts)
        points = _points(joined)
        small = _small(points)
        space = SPACE.take(small)
        bound = points == ord("\n")
        bound[:-1] |= space[1:] & STOP.take(small[:-1])
        ends = np.append(np.flatnonzero(bound) + 1, len(points))
        marks, stops = _word_edges(space)
        lower = joined.lower()
        points = _points(lower)
        self.hashes = _word_hashes(points, *((marks, stops) if len(lower) == len(joined) else _word_edges(SPACE.take(_small(points)))))
        part = np.searchsorted(ends, marks, "right")
        new = np.diff(part, prepend=-1) != 0
        place = np.cumsum(new) - 1
        head = new.copy()
        if len(marks):
            head[1:] |= _content_cuts(self.hashes, place, np.bincount(place))
        heads = np.flatnonzero(head)
        pieces = (np.diff(heads, append=len(marks)) - 1) // LONGEST + 1
        firsts = np.repeat(heads, pieces) + LONGEST * ragged(np.zeros(len(heads), np.int64), pieces)
        n = len(firsts)
        self.text_of = np.searchsorted(self.begins, marks[firsts], "right") - 1
        self.starts = np.where(new[firsts], np.append(0, ends)[part[firsts]], marks[firsts])
        self.stops = np.minimum(ends[part[firsts]], (self.begins + sizes)[self.text_of])
        inner = np.flatnonzero(~new[firsts])
        self.stops[inner - 1] = self.starts[inner]
        self.low, self.high = (np.searchsorted(self.text_of, np.arange(len(texts)), side) for side in ("left", "right"))
        self.total = np.append(firsts, len(marks))
        self.lasts = np.maximum(np.arange(n) + run, np.searchsorted(self.total, self.total[:-1] + words))
        self.valid = self.lasts <= self.high[self.text_of]
        # The hashes of words, with a zero behind each sentence.
        spread = np.zeros(len(marks) + n, np.uint64)
        spread[np.arange(len(marks)) + np.repeat(np.arange(n), np.diff(self.total))] = self.hashes
        self.view = memoryview(spread).cast("B") if n else b""

    def digests(self, firsts):
        """The 128-bit hashes of the spans that start at these sentences, as rows of two numbers."""
        lasts = self.lasts[firsts]
        begins, ends = (self.total[firsts] + firsts) * 8, (self.total[lasts] + lasts - 1) * 8
        digest, view = xxhash.xxh3_128_digest, self.view
        found = b"".join([digest(view[a:b]) for a, b in zip(begins.tolist(), ends.tolist())])
        return np.frombuffer(found, np.int64).reshape(-1, 2)


def _groups(texts):
    """(first, last) of the texts of a block that are cut at once."""
    first = total = 0
    for i, text in enumerate(texts):
        if total and total + len(text) > GROUP:
            yield first, i
            first, total = i, 0
        total += len(text)
    if first < len(texts):
        yield first, len(texts)


SPANS = "high long, low long, id long, place int, settled boolean"


def _settle(high, low, ids, places):
    """The spans of a block, each hash's first one and those that are surely not the first (`settled`).

    A settled span has nothing more to meet, so its second half is mixed with
    its place: it goes to any task, not to the one of its hash.
    """
    order = np.lexsort((places, ids, low, high))
    high, low, ids, places = (a[order] for a in (high, low, ids, places))
    new, again = np.ones(len(high), bool), np.zeros(len(high), bool)
    new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    again[1:] = ~new[1:] & (ids[1:] == ids[:-1]) & (places[1:] == places[:-1])
    high, low, ids, places, settled = (a[~again] for a in (high, low, ids, places, ~new))
    low = np.where(settled, low ^ ((ids << 20) + places) * np.int64(MIX >> 1), low)
    return batch(SPANS, high, low, ids, places.astype(np.int32), pa.array(settled))


def _hash(run, words):
    def task(batches):
        for rows in batches:
            ids, texts = rows.column(0).to_numpy(), rows.column(1).to_pylist()
            found = [], [], []
            for a, b in _groups(texts):
                group = Group(texts[a:b], run, words)
                firsts = np.flatnonzero(group.valid)
                of = group.text_of[firsts]
                for kept, values in zip(found, (group.digests(firsts), ids[a:b][of], firsts - group.low[of])):
                    kept.append(values)
            if texts:
                hashes, of, places = map(np.concatenate, found)
                yield _settle(hashes[:, 0], hashes[:, 1], of, places)

    return task


KEPT = "id long, n_sentences long, n_removed long, n_chars_removed long, kept string"


def _remove(run, words, digest):
    schema = KEPT.replace("kept string", "kept_sha256 string") if digest else KEPT

    def task(batches):
        for rows in batches:
            marks = rows.column(2)
            sizes = marks.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = marks.flatten()
            marked = [flat.field(n).to_numpy(zero_copy_only=False) for n in ("place", "high")]
            ends = np.append(0, np.cumsum(sizes))
            ids, texts = rows.column(0).to_pylist(), rows.column(1).to_pylist()
            for a, b in _groups(texts):
                group = Group(texts[a:b], run, words)
                of = np.repeat(np.arange(b - a), sizes[a:b])
                places, highs = (m[ends[a] : ends[b]] for m in marked)
                at = group.low[of] + places
                # Rows that share an identifier have the marks of all their texts.
                fits = at < group.high[of]
                fits[fits] = group.valid[at[fits]]
                at, highs = at[fits], highs[fits]
                at = at[group.digests(at)[:, 0] == highs]
                steps = np.zeros(len(group.starts) + 1, np.int64)
                np.add.at(steps, at, 1)
                np.add.at(steps, group.lasts[at], -1)
                gone = np.flatnonzero(np.cumsum(steps)[:-1])
                of = group.text_of[gone]
                begins, stops = group.starts[gone] - group.begins[of], group.stops[gone] - group.begins[of]
                n_gone = np.bincount(of, minlength=b - a)
                n_chars = np.bincount(of, stops - begins, minlength=b - a).astype(np.int64)
                edges = np.append(0, np.cumsum(n_gone)).tolist()
                begins, stops = begins.tolist(), stops.tolist()
                kept = []
                for text, i, j in zip(texts[a:b], edges, edges[1:]):
                    if i < j:
                        text = "".join([text[x:y] for x, y in zip([0, *stops[i:j]], [*begins[i:j], len(text)])])
                    kept.append(hashlib.sha256(text.encode()).hexdigest() if digest else text)
                yield batch(schema, ids[a:b], group.high - group.low, n_gone, n_chars, kept)

    return task, schema


def remove_repeats(frame, id="doc_id", text="text", run=3, words=12, digest=False):
    """Each text without the sentences that a repeated span covers, other than where the span first occurs.

    A span is `run` consecutive sentences, and more where those have fewer than
    `words` words. Spans are equal if their words are, lower-cased; the first
    is that of the smallest identifier, and in a text that of the smallest
    place. Returns the identifier, n_sentences, n_removed, n_chars_removed and
    the text that is left, `kept` (or kept_sha256).

    A null or empty text has no sentence; a text shorter than a span is left
    whole. Rows that repeat identifier and text are one document. A row without
    identifier is left whole and removes nothing. Other columns are not read;
    an empty table gives none. Spans meet by a 128-bit hash, in one shuffle: a
    block sends each hash once with its smallest place, and what it holds again
    is settled there, so a span that a third of all documents hold meets once a
    block. All but the first of a hash go back to their documents.
    """
    rows = id_and_text(frame, id, text).select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    found = rows.filter("id IS NOT NULL").mapInArrow(_hash(run, words), SPANS)
    order = Window.partitionBy("high", "low").orderBy("id", "place")
    others = found.withColumn("rank", F.rank().over(order)).filter("settled OR rank > 1")
    places = others.groupBy("id").agg(F.collect_set(F.struct("place", "high")).alias("places"))
    task, schema = _remove(run, words, digest)
    return rows.join(places, "id", "left").mapInArrow(task, schema).withColumnRenamed("id", id)
