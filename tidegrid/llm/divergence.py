"""How far the sources of a language lie apart in the words they use.

The terms that enough documents of a language hold are its vocabulary. Sorted,
they are cut into pieces of bounded length, and each piece becomes a minimal
acyclic transducer: states that accept the same ends are one state, and the
arcs carry numbers that add up, along a term, to its place in the order of all
terms of the language. The text then runs through the transducers byte by byte,
all terms of a block at a time, and comes out as ordinals, which are counted,
compared and used to break ties. A round takes as many transducers to the tasks
as fit a fixed size, and reads only the documents of their languages.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegrid.llm.support import batch
from tidegrid.session import store

# The bytes of terms, A-Z lower-cased; all others separate and become 0.
BYTES = np.array([b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0 for b in range(256)], np.uint8)
# Terms of one transducer, terms of one block of comparisons, sources of one.
PIECE, TERMS, SOURCES = 131_072, 4_096, 256
ROUND_BYTES = 32 << 20
# Places that a state is tried at before the search leaves the crowded ones behind.
TRIES = 64
TOKENS = 1 << 20
# Text of one block: the places of its terms take many times its size.
BLOCK_BYTES = 4 << 20

SHARD = "lang string, first binary, terms long, states binary"


def minimal(terms):
    """The arcs of each state of the least automaton of sorted, distinct byte strings, and how many strings each accepts.

    State 0 is the end, reached by a byte 0 behind a term; the last is the start.
    """
    arcs, sizes, known = [()], [1], {(): 0}
    path, before = [[]], b""

    def freeze(depth):
        while len(path) > depth:
            state = tuple(path.pop())
            number = known.get(state)
            if number is None:
                number = known[state] = len(arcs)
                arcs.append(state)
                sizes.append(sum(sizes[child] for _, child in state))
            path[-1][-1] = (path[-1][-1][0], number)

    for term in terms:
        term += b"\0"
        same = next((i for i, (a, b) in enumerate(zip(before, term)) if a != b), 0)
        freeze(same + 1)
        for byte in term[same:]:
            path[-1].append((byte, 0))
            path.append([])
        path.pop()
        before = term
    freeze(1)
    arcs.append(tuple(path[0]))
    sizes.append(sum(sizes[child] for _, child in path[0]))
    return arcs, sizes


def transducer(terms):
    """Sorted, distinct byte strings as the bytes of a transducer from a term to its place.

    A state is a number, and its arc for a byte lies at state + byte of three
    rows: the state that the arc belongs to, the one it leads to, and the number
    of terms that come before all those behind the arc.
    """
    arcs, sizes = minimal(terms)
    used, placed, taken, begin = bytearray(2048), {}, set(), {}
    # Wide states first, since they fit only where there is space; for each width the search goes on where it became slow.
    for state in sorted(range(1, len(arcs)), key=lambda s: -len(arcs[s])):
        steps = [byte for byte, _ in arcs[state]]
        slot = begin.get(len(steps), 256)
        while used[slot]:
            slot += 1
        begin[len(steps)] = slot
        at, tries = slot - steps[0], 0
        while at in taken or any(used[at + byte] for byte in steps):
            at, tries = at + 1, tries + 1
            if at + 1024 > len(used):
                used += bytes(len(used))
        if tries > TRIES:
            begin[len(steps)] = at + steps[0]
        taken.add(at)
        placed[state] = at
        for byte in steps:
            used[at + byte] = 1
        if at + 1024 > len(used):
            used += bytes(len(used))
    length = max(placed.values()) + 256
    owner = np.full(length, -1, np.int32)
    target, output = np.zeros(length, np.int32), np.zeros(length, np.int32)
    for state, at in placed.items():
        below = 0
        for byte, child in arcs[state]:
            owner[at + byte], target[at + byte], output[at + byte] = at, placed.get(child, 0), below
            below += sizes[child]
    start = placed[len(arcs) - 1]
    return np.concatenate([np.array([start], np.int32), owner, target, output]).tobytes()


def opened(held):
    """(start, owner, target, output) of a transducer's bytes."""
    whole = np.frombuffer(held, np.int32)
    return int(whole[0]), *whole[1:].reshape(3, -1)


def places(machine, text, starts):
    """The place of the term that begins at each start, -1 for one that is not in the transducer; a byte 0 ends a term."""
    start, owner, target, output = machine
    found = np.full(len(starts), -1, np.int64)
    alive, at = np.arange(len(starts)), starts
    state, place = np.full(len(starts), start, np.int32), np.zeros(len(starts), np.int32)
    while len(alive):
        byte = text[at]
        slot = state + byte
        known = owner[slot] == state
        place = place + output[slot]
        ended = known & (byte == 0)
        found[alive[ended]] = place[ended]
        on = known & (byte != 0)
        alive, at, place, state = alive[on], at[on] + 1, place[on], target[slot[on]]
    return found


def spelled(machine):
    """All terms of a transducer in order."""
    start, owner, target, _ = machine
    stack = [(start, b"")]
    while stack:
        state, before = stack.pop()
        bytes_ = np.flatnonzero(owner[state : state + 256] == state)
        for byte in reversed(bytes_.tolist()):
            if byte:
                stack.append((int(target[state + byte]), before + bytes([byte])))
        # The end comes before all longer terms.
        if len(bytes_) and bytes_[0] == 0:
            yield before


def tokens(column):
    """(text, starts, lengths, row) of the terms of a text column whose texts all end in a separator."""
    raw = column.cast(pa.large_binary())
    ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    text = BYTES[np.frombuffer(raw.buffers()[2], np.uint8)[ends[0] : ends[-1]]] if ends[-1] > ends[0] else np.zeros(0, np.uint8)
    inside = text != 0
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edges = np.concatenate([[0], edges])
    starts, stops = edges[0::2], edges[1::2]
    return text, starts, stops - starts, np.searchsorted(ends[1:] - ends[0], starts, "right")


def _read(frame, lang, source, text):
    """Language, source and text, null ones empty; a separator ends each text."""
    plain = {out: F.coalesce(F.col(c).cast("string"), F.lit("")) for out, c in (("lang", lang), ("source", source))}
    body = F.concat(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit("\n"))
    return frame.select(*[c.alias(out) for out, c in plain.items()], body.alias("text"))


def _coded(column):
    """A column as numbers, and the values that these stand for."""
    held = column.dictionary_encode()
    return held.indices.to_numpy(zero_copy_only=False).astype(np.int64), held.dictionary


def _blocks(batches, most=BLOCK_BYTES):
    """The rows of the batches, in blocks of at most so many bytes of text or of one row."""
    for held in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(held.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        low = 0
        while low < held.num_rows:
            high = max(low + 1, int(np.searchsorted(sizes, (sizes[low - 1] if low else 0) + most, "right")))
            yield held.slice(low, high - low)
            low = high


def _terms_of(batches):
    """How many documents of each language hold a term, block by block."""
    for block in _blocks(batches):
        text, starts, lengths, row = tokens(block.column("text"))
        if not len(starts):
            continue
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(text[text != 0])])
        word, known = _coded(words)
        langs, names = _coded(block.column("lang"))
        # One of each (document, term), then how often each (language, term).
        pairs = np.unique(row * len(known) + word)
        kinds, counts = np.unique(langs[pairs // len(known)] * len(known) + pairs % len(known), return_counts=True)
        yield batch("lang string, term binary, n long", names.take(kinds // len(known)), known.take(kinds % len(known)).cast(pa.binary()), counts)


def vocabulary(rows, least=30, piece=PIECE):
    """Transducers of the terms that at least `least` rows of a language hold: (lang, base, terms, states).

    `base` is the ordinal of the first term of a piece in its language. Terms are dealt by ranges, so a
    language is not held by one task; pieces are cut at `piece` terms and at the ends of the ranges.
    """
    counted = rows.select("lang", "text").mapInArrow(_terms_of, "lang string, term binary, n long")
    kept = counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("lang", "term")
    kept = store(kept, "terms")

    def build(batches):
        lang, terms = None, []

        def closed():
            return batch(SHARD, [lang], [terms[0]], [len(terms)], [transducer(terms)])

        for block in batches:
            for name, term in zip(block.column("lang").to_pylist(), block.column("term").to_pylist()):
                if terms and (name != lang or len(terms) >= piece):
                    yield closed()
                    terms = []
                lang = name
                terms.append(term)
        if terms:
            yield closed()

    built = kept.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(build, SHARD)
    # A row for each piece, far fewer than there are terms.
    before = Window.partitionBy("lang").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    pieces = store(built, "pieces")
    based = pieces.select("lang", F.coalesce(F.sum("terms").over(before), F.lit(0)).alias("base"), "first", "terms")
    return store(based.join(pieces.drop("terms"), ["lang", "first"]).select("lang", "base", "terms", "states"), "vocabulary")


def _rounds(pieces, most):
    """The pieces in rounds of at most `most` bytes each, a single larger one by itself."""
    sizes = pieces.select("lang", "base", F.octet_length("states").alias("size")).orderBy("lang", "base").collect()
    rounds, room = [], 0
    for row in sizes:
        if not rounds or row.size > room:
            rounds.append([])
            room = most
        rounds[-1].append((row.lang, row.base))
        room -= row.size
    return rounds


def _counted(machines):
    """Occurrences of each term by source, block by block."""
    held = {}
    for lang, base, states in machines:
        held.setdefault(lang, []).append((base, opened(states)))

    def run(batches):
        for block in _blocks(batches):
            text, starts, _, row = tokens(block.column("text"))
            langs, names = _coded(block.column("lang"))
            sources, origins = _coded(block.column("source"))
            for number, name in enumerate(names.to_pylist()):
                mine = np.flatnonzero(langs[row] == number) if len(names) > 1 else np.arange(len(row))
                for base, machine in held.get(name, ()):
                    found, wide = [], int(machine[3].max(initial=0)) + 2
                    for low in range(0, len(mine), TOKENS):
                        some = mine[low : low + TOKENS]
                        place = places(machine, text, starts[some])
                        seen = place >= 0
                        found.append(np.stack(np.unique(sources[row[some[seen]]] << 32 | place[seen], return_counts=True)))
                    if not found:
                        continue
                    keys, which = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
                    counts = np.bincount(which, np.concatenate([f[1] for f in found]), len(keys)).astype(np.int64)
                    yield batch("lang string, source string, ordinal long, n long", [name] * len(keys), origins.take(keys >> 32), (keys & (1 << 32) - 1) + base, counts)

    return run


def recount(rows, pieces, round_bytes=ROUND_BYTES):
    """Occurrences of each kept term by language and source, from the text run through the transducers."""
    out = None
    for members in _rounds(pieces, round_bytes):
        # One round's transducers, of bounded size; in the order of languages and terms a round is a range.
        low, high = [F.struct(F.lit(lang).alias("lang"), F.lit(base).cast("long").alias("base")) for lang, base in (members[0], members[-1])]
        held = pieces.where(F.struct("lang", "base").between(low, high))
        machines = [(r.lang, r.base, bytes(r.states)) for r in held.collect()]
        langs = sorted({m[0] for m in machines})
        mine = rows.where(F.col("lang").between(langs[0], langs[-1]))
        part = mine.mapInArrow(_counted(machines), "lang string, source string, ordinal long, n long")
        # A term lies in one piece, so rounds do not meet in a sum.
        part = store(part.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")), "counts")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = rows.sparkSession.createDataFrame([], "lang string, source string, ordinal long, n long")
    return out


def _share(count, total):
    """p of a term with so many occurrences among `total` = N + 5 V, in whole numbers."""
    grown = (count.cast("decimal(20,0)") + 5).cast("decimal(21,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", grown, total.cast("decimal(20,0)"))


def audit(frame, lang="lang", source="source", text="text", least=30, top=50, piece=PIECE, round_bytes=ROUND_BYTES):
    """Divergence of each source of a language from each other one, and the terms that mark it most.

    Null language, source and text are empty ones; each row is a document,
    repeated rows and shared identifiers included; no other column plays a part.
    Part `pair` has a row for each other source of the language, with value 0
    where the language keeps no term; part `term` the `top` terms that a source
    uses more than its language. Ties go to the smaller item in UTF-8. An empty
    table gives no rows. All numbers are exact.

    All pairs of sources of a language are the result, so its size grows with
    their square; they are compared in blocks of sources and terms.
    """
    rows = _read(frame, lang, source, text)
    pieces = vocabulary(rows, least, piece)
    counts = recount(rows, pieces, round_bytes)
    kept = pieces.groupBy("lang").agg(F.sum("terms").alias("v"))
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    numbered = Window.partitionBy("lang").orderBy("source")
    groups = (
        rows.select("lang", "source")
        .distinct()
        .join(sums, ["lang", "source"], "left")
        .join(kept, "lang", "left")
        .select("lang", "source", (F.row_number().over(numbered) - 1).cast("long").alias("no"), F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("n", F.lit(0)).alias("n"))
        .withColumn("total", F.col("n") + 5 * F.col("v"))
    )
    groups = store(groups, "groups")
    return _pairs(groups, counts).unionByName(_marks(groups, counts, pieces, top))


def _pairs(groups, counts):
    """The distance of all pairs of sources of each language, block by block."""
    last = groups.groupBy("lang").agg(F.max("no").alias("last"))
    some = groups.where("v > 0").join(last, "lang")
    zero = some.select(
        "lang",
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(v - 1) div {TERMS}"))).alias("terms"),
        F.lit(-1).cast("long").alias("ordinal"),
        "no",
        _share(F.lit(0), F.col("total")).alias("p"),
        "v",
        "last",
    )
    own = counts.join(some.drop("n"), ["lang", "source"]).select(
        "lang", F.expr(f"ordinal div {TERMS}").alias("terms"), "ordinal", "no", _share(F.col("n"), F.col("total")).alias("p"), "v", "last"
    )
    block = F.expr(f"no div {SOURCES}")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"last div {SOURCES}"))).alias("other")
    dealt = zero.unionByName(own).select("lang", "terms", "ordinal", "no", "p", "v", block.alias("mine"), other)
    dealt = dealt.select("lang", "terms", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "ordinal", "no", "p", "v")

    def compare(key, table):
        lang, terms, low, high = [k.as_py() for k in key]
        ordinal, no, p = [table.column(c).to_numpy().astype(np.int64) for c in ("ordinal", "no", "p")]
        width = min(TERMS, table.column("v")[0].as_py() - terms * TERMS)
        known, row = np.unique(no, return_inverse=True)
        grid = np.empty((len(known), width), np.int64)
        blank = ordinal < 0
        grid[row[blank]] = p[blank][:, None]
        grid[row[~blank], ordinal[~blank] - terms * TERMS] = p[~blank]
        first, second, value = [], [], []
        for i, a in enumerate(known):
            if a // SOURCES != low:
                continue
            far = np.flatnonzero((known > a) & (known // SOURCES == high))
            if len(far):
                first.append(np.full(len(far), a))
                second.append(known[far])
                value.append(np.abs(grid[far] - grid[i]).sum(1))
        if not first:
            return pa.table({"lang": pa.array([], pa.string()), "a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "f": pa.array([], pa.int64())})
        a, b, f = [np.concatenate(x) for x in (first, second, value)]
        return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": a, "b": b, "f": f})

    parts = dealt.groupBy("lang", "terms", "low", "high").applyInArrow(compare, "lang string, a long, b long, f long")
    found = parts.groupBy("lang", "a", "b").agg(F.sum("f").alias("value"))
    bare = groups.where("v = 0").select("lang", F.col("no").alias("a"))
    found = found.unionByName(bare.join(bare.withColumnRenamed("a", "b"), "lang").where("a < b").select("lang", "a", "b", F.lit(0).cast("long").alias("value")))
    both = found.unionByName(found.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    named = lambda column, out: groups.select("lang", F.col("no").alias(column), F.col("source").alias(out))
    shown = both.join(named("a", "source"), ["lang", "a"]).join(named("b", "item"), ["lang", "b"])
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return shown.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))


def _marks(groups, counts, pieces, top):
    """The terms that each source has more of than its language."""
    whole = groups.groupBy("lang").agg((F.sum("n") + 5 * F.max("v")).alias("all"))
    common = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("in_lang")).join(whole, "lang")
    common = common.select("lang", "ordinal", _share(F.col("in_lang"), F.col("all")).alias("q"))
    own = counts.join(groups.drop("n"), ["lang", "source"]).select("lang", "source", "ordinal", _share(F.col("n"), F.col("total")).alias("p"))
    more = own.join(common, ["lang", "ordinal"]).where("p > q").select("lang", "source", "ordinal", (F.col("p") - F.col("q")).alias("value"))
    # Ordinals follow the order of the terms, so they settle ties; only `top` rows a source are sent on from a task.
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    best = more.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)

    def spell(batches):
        for block in batches:
            for lang, base, states in zip(*[block.column(c).to_pylist() for c in ("lang", "base", "states")]):
                terms = [t.decode(errors="replace") for t in spelled(opened(states))]
                yield batch("lang string, ordinal long, item string", [lang] * len(terms), np.arange(len(terms)) + base, terms)

    named = pieces.select("lang", "base", "states").mapInArrow(spell, "lang string, ordinal long, item string")
    return best.join(named, ["lang", "ordinal"]).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
