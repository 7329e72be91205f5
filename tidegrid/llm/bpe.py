"""Byte-level BPE by replaying the merges over a corpus of distinct words."""

import base64
import hashlib
import heapq
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import functions as F

from tidegrid.llm.support import batch, id_and_text, ragged

# Distinct pieces that a task remembers from block to block.
REMEMBERED = 400_000
NONE = np.int32(2**31 - 1)


class Merges:
    """The vocabulary of ranks, as tables that numpy can look up."""

    def __init__(self, ranks_file, pattern):
        tokens = dict(map(bytes.split, ranks_file.splitlines()))
        ranks = {base64.b64decode(token): int(rank) for token, rank in tokens.items()}
        self.pattern = regex.compile(pattern)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        keys = np.array(sorted(pairs), np.int64)
        self.keys = np.append(keys, np.int64(2**62))
        self.merged = np.array([pairs[k] for k in keys.tolist()] + [NONE], np.int32)
        size = max(ranks.values()) + 1
        # Tokens that a neighbour can turn into a token of lower rank.
        self.sinks = np.zeros(size, bool)
        for part in (self.keys[:-1] >> 32, self.keys[:-1] & (2**32 - 1)):
            self.sinks[part[self.merged[:-1] < part]] = True
        self.sizes = np.zeros(size, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)
        self.starts = np.cumsum(self.sizes) - self.sizes
        by_rank = {rank: token for token, rank in ranks.items()}
        self.bytes = np.frombuffer(b"".join(by_rank.get(r, b"") for r in range(size)), np.uint8)

    def pair(self, left, right):
        """The token that two neighbours merge to, or NONE."""
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.merged[at], NONE)

    def replay(self, words):
        """Token ids of each word: a flat array and the length of each run.

        All words lie in one array of symbols. An index has, for each pair that
        can merge (by the rank of its token), the positions where it stands. The
        pair of lowest rank is applied at all its positions that do not overlap,
        leftmost first, and only the two neighbours of each change are looked up
        anew. Where that brings up a pair of lower rank, the places that follow
        in the word wait, for that pair comes first.
        """
        sizes = np.array([len(w) for w in words], np.int64)
        symbols = self.single[np.frombuffer(b"".join(words), np.uint8)]
        total = len(symbols)
        word = np.repeat(np.arange(len(words)), sizes)
        # Position `total` stands for the end of any word.
        after = np.arange(1, total + 2)
        before = np.arange(-1, total)
        ends = np.cumsum(sizes)[sizes > 0]
        after[ends - 1] = total
        before[(ends - sizes[sizes > 0])] = total
        symbols = np.append(symbols, np.int32(-1))
        rank = np.full(total + 1, NONE, np.int32)
        inner = np.nonzero(after[:total] < total)[0]
        rank[inner] = self.pair(symbols[inner], symbols[after[inner]])
        index, order = {}, []

        def note(places):
            places = places[rank[places] < NONE]
            if not len(places):
                return
            found = rank[places]
            by = np.argsort(found, kind="stable")
            found, places = found[by], places[by]
            cuts = np.nonzero(found[1:] != found[:-1])[0] + 1
            firsts = found[np.append(0, cuts)].tolist()
            for value, run in zip(firsts, np.split(places, cuts) if len(cuts) else [places]):
                held = index.get(value)
                if held is None:
                    index[value] = [run]
                    heapq.heappush(order, value)
                else:
                    held.append(run)

        note(inner)
        while order:
            value = heapq.heappop(order)
            runs = index.pop(value)
            places = np.unique(np.concatenate(runs))
            places = places[rank[places] == value]
            if not len(places):
                continue
            if len(places) > 1:
                # Of places that overlap in a row every other one is left when its turn comes.
                every = places
                apart = np.append(True, after[places[:-1]] != places[1:])
                starts = np.nonzero(apart)[0]
                places = places[(np.arange(len(places)) - starts[np.cumsum(apart) - 1]) % 2 == 0]
                if self.sinks[value]:
                    waits = self.after_lower(value, places, symbols, before, after, word)
                    if waits.any():
                        index[value] = [every]
                        heapq.heappush(order, value)
                        places = places[~waits]
            gone = after[places]
            follow = after[gone]
            symbols[places] = value
            after[places] = follow
            before[follow] = places
            rank[gone] = NONE
            symbols[gone] = -1
            ahead = before[places]
            here = places[follow < total]
            rank[places] = NONE
            rank[here] = self.pair(symbols[here], symbols[after[here]])
            ahead = ahead[ahead < total]
            rank[ahead] = self.pair(symbols[ahead], symbols[after[ahead]])
            note(np.concatenate([here, ahead]))
        left = symbols[:total] >= 0
        return symbols[:total][left], np.bincount(word[left], minlength=len(words))

    def after_lower(self, value, places, symbols, before, after, word):
        """Whether making `value` at an earlier place of the same word brings up a pair of lower rank."""
        follow = after[after[places]]
        left, right = symbols[before[places]], symbols[follow]
        beside = np.nonzero(follow[:-1] == places[1:])[0] + 1
        left[beside] = value
        here = np.full(len(places), value, np.int32)
        lower = (left >= 0) & (self.pair(left, here) < value) | (right >= 0) & (self.pair(here, right) < value)
        if not lower.any():
            return lower
        # How many such places of its word stand before each.
        owner = word[places]
        first = np.nonzero(np.append(True, owner[1:] != owner[:-1]))[0]
        earlier = np.cumsum(lower) - lower
        return earlier > np.repeat(earlier[first], np.diff(np.append(first, len(places))))

    def decode(self, ids):
        """The bytes of an array of token ids."""
        sizes = self.sizes[ids]
        return self.bytes[ragged(self.starts[ids], sizes)]


@lru_cache(maxsize=2)
def merges(ranks_file, pattern):
    return Merges(ranks_file, pattern)


class Spaced(dict):
    """Numbers of the pieces that follow a space; -1 if the cut there is no sure one."""

    def __init__(self, units):
        super().__init__()
        self.units = units

    def __missing__(self, piece):
        number = -1
        if piece and len(piece.strip()) == len(piece):
            number = len(self.units)
            self.units.append(" " + piece)
        self[piece] = number
        return number


class Words(dict):
    """Numbers of single matches."""

    def __init__(self, units):
        super().__init__()
        self.units = units

    def __missing__(self, word):
        self[word] = number = len(self.units)
        self.units.append((word,))
        return number


class Numbers(dict):
    """Numbers its keys in the order they are first asked for."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


class Corpus:
    """The distinct units of text that a task has met, with their tokens.

    A space that stands alone always begins a match, so a text whose spaces
    all do is cut there, and each distinct piece is matched once. In any other
    text every match is a unit.
    """

    def __init__(self, tables):
        self.tables = tables
        self.clear()

    def clear(self):
        self.units = []
        self.spaced, self.words = Spaced(self.units), Words(self.units)
        self.known = 0
        self.ids = np.zeros(0, np.int32)
        self.sizes = np.zeros(0, np.int64)

    def numbers(self, text):
        """Numbers of the units of a text, in order."""
        match, words = self.tables.pattern.findall, self.words
        first, *rest = text.split(" ")
        if not rest or not first[-1:].isspace():
            found = np.fromiter(map(self.spaced.__getitem__, rest), np.int64, len(rest))
            if not (found < 0).any():
                return np.append(np.array([words[w] for w in match(first)], np.int64), found)
        return np.array([words[w] for w in match(text)], np.int64)

    def learn(self):
        """Replay the merges over the words of all new units."""
        words, parts, sizes = Numbers(), [], []
        match = self.tables.pattern.findall
        for unit in self.units[self.known :]:
            found = unit if isinstance(unit, tuple) else match(unit)
            sizes.append(len(found))
            parts.extend(found)
        self.known = len(self.units)
        if not sizes:
            return
        parts = np.fromiter(map(words.__getitem__, parts), np.int64, len(parts))
        ids, lengths = self.tables.replay([w.encode() for w in words])
        starts = np.cumsum(lengths) - lengths
        total = np.append(0, np.cumsum(lengths[parts]))
        ends = np.cumsum(sizes)
        self.ids = np.append(self.ids, ids[ragged(starts[parts], lengths[parts])])
        self.sizes = np.append(self.sizes, total[ends] - total[ends - np.array(sizes)])

    def encode(self, texts):
        """Token ids of the texts: a flat array, and the number in each text."""
        if len(self.units) > REMEMBERED:
            self.clear()
        found = [self.numbers(text) for text in texts]
        self.learn()
        units = np.concatenate(found) if found else np.zeros(0, np.int64)
        starts = np.cumsum(self.sizes) - self.sizes
        counts = np.append(0, np.cumsum(self.sizes[units]))
        ends = np.cumsum([len(f) for f in found], dtype=np.int64)
        sizes = counts[ends] - counts[ends - np.array([len(f) for f in found], np.int64)]
        return self.ids[ragged(starts[units], self.sizes[units])], sizes


def _blocks(rows, most=4_000_000):
    """Parts of a batch of at most so many characters; a longer text is a part of its own."""
    texts, begin, size = rows.column(1).to_pylist(), 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield begin, texts[begin:i]
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, texts[begin:]


def _cut(values, sizes):
    """The bytes of each of several runs."""
    ends = np.cumsum(sizes) * values.itemsize
    data = memoryview(values.tobytes())
    return [data[e - s : e] for s, e in zip((sizes * values.itemsize).tolist(), ends.tolist())]


ENCODED = "id long, n_tokens long, ids binary"
DIGESTS = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
BOTH = DIGESTS + ", ids binary"


def _encode(ranks_file, pattern, schema):
    def run(batches):
        tables = merges(ranks_file, pattern)
        corpus = Corpus(tables)
        for rows in batches:
            for begin, texts in _blocks(rows):
                ids, sizes = corpus.encode(texts)
                keys = rows.column(0).slice(begin, len(texts))
                runs = _cut(ids.astype("<u4"), sizes)
                if schema == ENCODED:
                    yield batch(ENCODED, keys, sizes, [bytes(r) for r in runs])
                    continue
                lengths = np.append(0, np.cumsum(tables.sizes[ids]))
                ends = np.cumsum(sizes)
                decoded = _cut(tables.decode(ids), lengths[ends] - lengths[ends - sizes])
                hexes = [[hashlib.sha256(r).hexdigest() for r in side] for side in (runs, decoded)]
                yield batch(schema, keys, sizes, *hexes, *([[bytes(r) for r in runs]] if schema == BOTH else []))

    return run


def _decode(ranks_file, pattern):
    def run(batches):
        tables = merges(ranks_file, pattern)
        for rows in batches:
            found = [bytes(tables.decode(np.frombuffer(ids or b"", "<u4"))) for ids in rows.column(1).to_pylist()]
            yield batch("id long, decoded binary", rows.column(0), found)

    return run


def _ranks(path):
    with open(path, "rb") as file:
        return file.read()


def encode(frame, path, pattern, id="doc_id", text="text"):
    """Token ids of each whole text: the identifier, n_tokens and ids.

    `ids` is binary, one little-endian unsigned 32-bit integer per token.
    `path` names a file of base64 tokens and ranks, read on the driver (a
    vocabulary is a bounded table); each match of `pattern` is encoded by
    itself, without special tokens. A null or empty text has no tokens. Rows
    may repeat; other columns are not read; an empty table gives none.

    There is no shuffle. A task takes its documents in blocks, collects the
    distinct words of a block and replays the merges over that corpus once.
    """
    run = _encode(_ranks(path), pattern, ENCODED)
    return _narrow(frame, id, text).mapInArrow(run, ENCODED).withColumnRenamed("id", id)


def decode(frame, path, pattern, id="doc_id", ids="ids"):
    """The bytes that token ids stand for: the identifier and decoded. No ids (or null) decode to no bytes."""
    rows = frame.select(F.col(id).cast("long").alias("id"), F.col(ids).alias("ids"))
    return rows.mapInArrow(_decode(_ranks(path), pattern), "id long, decoded binary").withColumnRenamed("id", id)


def round_trip(frame, path, pattern, id="doc_id", text="text", ids=False):
    """n_tokens and the SHA-256 of the ids and of what they decode to, in one pass, and the ids if asked for.

    As `encode` and `decode`; what they decode to does not leave the task.
    """
    schema = BOTH if ids else DIGESTS
    run = _encode(_ranks(path), pattern, schema)
    return _narrow(frame, id, text).mapInArrow(run, schema).withColumnRenamed("id", id)


def _narrow(frame, id, text):
    return id_and_text(frame, id, text).select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
