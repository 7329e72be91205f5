"""Language identification by a bidirectional gated recurrent network over bytes."""

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegrid.llm.support import batch, id_and_text

SPAN = 64  # bytes that the network reads at once
PAD = 256  # a byte value that leaves the state as it is
UNITS = 8  # of each direction
LETTER = regex.compile(r"\p{L}")
SLICE = 640  # characters of one sampled text


def held_out(id):
    """One fifth of the rows, by a checksum of the identifier, that no model learns from."""
    return F.crc32(F.col(id).cast("string").cast("binary")) % 5 == 0


def sample(frame, id, text, lang, per_language):
    """Slices of at most `per_language` labelled texts of each language, the same on every run."""
    key = F.xxhash64(F.lit("language"), F.col(id))
    rows = frame.filter(~held_out(id) & F.col(lang).isNotNull() & (F.length(text) > 0))
    # A share of each language that surely holds enough, so that few rows are put in order.
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    if not counts:
        return []
    total = F.create_map(*[F.lit(x) for pair in counts.items() for x in pair])[F.col(lang)]
    rows = rows.select(F.col(lang).alias("lang"), F.col(id).alias("id"), key.alias("key"), F.col(text).alias("text"), total.alias("total"))
    rows = rows.filter(F.pmod("key", "total") < 4 * per_language)
    begin = (F.pmod(F.col("key"), F.greatest(F.length("text") - SLICE, F.lit(0)) + 1) + 1).cast("int")
    rows = rows.select("lang", "id", "key", F.col("text").substr(begin, F.lit(SLICE)).alias("text"))
    order = Window.partitionBy("lang").orderBy("key", "id", "text")
    rows = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_language)
    return [(r.lang, r.text) for r in rows.orderBy("lang", "n").collect()]


def windows(texts):
    """The bytes of the texts in columns of SPAN.

    Returns the columns, the text of each, and which positions count: the last
    window of a text is moved back to end with it, and counts only its new part.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = -(-sizes // SPAN)
    owner = np.repeat(np.arange(len(texts)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = number * SPAN
    moved = np.clip(np.minimum(begin, sizes[owner] - SPAN), 0, None)
    base = (np.cumsum(sizes) - sizes)[owner]
    place = moved[:, None] + np.arange(SPAN)
    inside = place < sizes[owner][:, None]
    data = np.frombuffer(b"".join(texts) + b"\0", np.uint8).astype(np.int16)
    values = np.where(inside, data[np.where(inside, base[:, None] + place, 0)], PAD)
    counted = inside & (place >= begin[:, None])
    return np.ascontiguousarray(values.T), owner, np.ascontiguousarray(counted.T)


def softsign(x):
    """x / (1 + |x|): what gates and candidates use for tanh, at a fraction of its time."""
    return x / (1 + abs(x))


class Direction:
    """One gated recurrent layer; arrays are units x windows."""

    NAMES = ("table", "inner")

    def __init__(self, rng):
        self.table = rng.normal(0, 0.3, (3 * UNITS, PAD + 1)).astype(np.float32)
        self.table[:, PAD] = 0
        self.table[:UNITS, PAD] = 1e30  # the update gate keeps the state
        self.inner = rng.normal(0, 1 / np.sqrt(UNITS), (3 * UNITS, UNITS)).astype(np.float32)

    def run(self, values, steps):
        """States after each step, and what back-propagation needs."""
        states = np.zeros((len(values), UNITS, values.shape[1]), np.float32)
        kept = []
        state = np.zeros((UNITS, values.shape[1]), np.float32)
        for t in steps:
            given = self.table[:, values[t]]
            own = self.inner @ state
            gates = 0.5 + 0.5 * softsign(given[: 2 * UNITS] + own[: 2 * UNITS])
            update, reset = gates[:UNITS], gates[UNITS:]
            fresh = softsign(given[2 * UNITS :] + reset * own[2 * UNITS :])
            kept.append((state, update, reset, fresh, own[2 * UNITS :]))
            state = fresh + update * (state - fresh)
            states[t] = state
        return states, kept

    def back(self, values, steps, kept, slopes):
        """Gradients of the parameters, from those of the states, through time."""
        table, inner = np.zeros_like(self.table), np.zeros_like(self.inner)
        carried = 0
        for t, (state, update, reset, fresh, own) in zip(reversed(steps), reversed(kept)):
            slope = slopes[t] + carried
            d_fresh = slope * (1 - update) * (1 - abs(fresh)) ** 2
            d_update = slope * (state - fresh) * 0.5 * (1 - abs(2 * update - 1)) ** 2
            d_reset = d_fresh * own * 0.5 * (1 - abs(2 * reset - 1)) ** 2
            given = np.concatenate([d_update, d_reset, d_fresh])
            own = np.concatenate([d_update, d_reset, d_fresh * reset])
            for unit in range(3 * UNITS):
                table[unit] += np.bincount(values[t], given[unit], PAD + 1)
            inner += own @ state.T
            carried = slope * update + self.inner.T @ own
        table[:, PAD] = 0
        return [table, inner]

    def score(self, values, steps, weights, scores):
        """Add this direction's part of the scores of every position; as `run`, without what only training needs."""
        n = values.shape[1]
        state = np.zeros((UNITS, n), np.float32)
        given, own, size = (np.empty((3 * UNITS, n), np.float32) for _ in range(3))
        gates, fresh, mine = given[: 2 * UNITS], given[2 * UNITS :], own[2 * UNITS :]
        for t in steps:
            np.take(self.table, values[t], axis=1, out=given, mode="clip")
            np.matmul(self.inner, state, out=own)
            gates += own[: 2 * UNITS]
            np.abs(gates, out=size[: 2 * UNITS])
            size[: 2 * UNITS] += 1
            gates /= size[: 2 * UNITS]
            gates *= 0.5
            gates += 0.5
            mine *= gates[UNITS:]
            fresh += mine
            np.abs(fresh, out=size[2 * UNITS :])
            size[2 * UNITS :] += 1
            fresh /= size[2 * UNITS :]
            state -= fresh
            state *= gates[:UNITS]
            state += fresh
            scores[t] += weights @ state


class Network:
    """Both directions and a label for every position."""

    def __init__(self, languages, seed=7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.ahead, self.behind = Direction(rng), Direction(rng)
        self.out = rng.normal(0, 0.3, (len(languages), 2 * UNITS)).astype(np.float32)
        self.bias = np.zeros((len(languages), 1), np.float32)

    def parameters(self):
        return [self.ahead.table, self.ahead.inner, self.behind.table, self.behind.inner, self.out, self.bias]

    def gradients(self, values, counted, labels):
        forth, back = range(SPAN), range(SPAN - 1, -1, -1)
        one, kept_one = self.ahead.run(values, forth)
        two, kept_two = self.behind.run(values, back)
        both = np.concatenate([one, two], axis=1)
        scores = self.out @ both + self.bias
        scores -= scores.max(1, keepdims=True)
        chances = np.exp(scores)
        chances /= chances.sum(1, keepdims=True)
        chances[:, labels, np.arange(len(labels))] -= 1
        slopes = chances * (counted[:, None, :] / max(1, counted.sum()))
        d_out = np.einsum("tkn,tun->ku", slopes, both, optimize=True)
        d_both = self.out.T @ slopes
        d_one = self.ahead.back(values, forth, kept_one, d_both[:, :UNITS])
        d_two = self.behind.back(values, back, kept_two, d_both[:, UNITS:])
        return [*d_one, *d_two, d_out, slopes.sum((0, 2))[:, None]]

    def fit(self, texts, labels, steps, size=192, rate=0.02, seed=11):
        """Back-propagation through time over windows of the sample, with adaptive steps."""
        values, owner, counted = windows(texts)
        labels = np.asarray(labels)[owner]
        rng = np.random.default_rng(seed)
        means = [np.zeros_like(p) for p in self.parameters()]
        squares = [np.zeros_like(p) for p in self.parameters()]
        by_label = [np.nonzero(labels == k)[0] for k in range(len(self.languages))]
        by_label = [b for b in by_label if len(b)]
        for step in range(1, steps + 1):
            pick = np.concatenate([rng.choice(b, -(-size // len(by_label))) for b in by_label])
            found = self.gradients(values[:, pick], counted[:, pick], labels[pick])
            norm = np.sqrt(sum(float((g * g).sum()) for g in found))
            pace = rate * min(1.0, 4 * (1 - step / (steps + 1)))
            for p, g, mean, square in zip(self.parameters(), found, means, squares):
                g = g * min(1, 1 / max(norm, 1e-9))
                mean += 0.1 * (g - mean)
                square += 0.01 * (g * g - square)
                p -= (pace * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self

    def pooled(self, texts, at_once=1024):
        """Mean chances of all positions of each text."""
        totals = np.zeros((len(texts), len(self.languages)))
        values, owner, counted = windows(texts)
        for begin in range(0, len(owner), at_once):
            part = np.ascontiguousarray(values[:, begin : begin + at_once], np.intp)
            n = part.shape[1]
            scores = np.empty((SPAN, len(self.languages), n), np.float32)
            scores[:] = self.bias
            self.ahead.score(part, range(SPAN), self.out[:, :UNITS], scores)
            self.behind.score(part, range(SPAN - 1, -1, -1), self.out[:, UNITS:], scores)
            np.exp(np.clip(scores, -60, 60, out=scores), out=scores)
            scores *= (counted[:, begin : begin + n] / scores.sum(1))[:, None]
            sums = scores.sum(0)
            for k in range(len(self.languages)):
                totals[:, k] += np.bincount(owner[begin : begin + n], sums[k], len(texts))
        return totals / np.maximum([[len(t)] for t in texts], 1) if len(texts) else totals


def train(frame, id="doc_id", text="text", lang="lang", per_language=300, steps=160):
    """A network from at most `per_language` texts of each language, without the held-out fifth; None if there is no label.

    The sample is bounded, so it is fitted on the driver.
    """
    rows = sample(frame, id, text, lang, per_language)
    languages = sorted({label for label, _ in rows})
    if not languages:
        return None
    network = Network(languages)
    return network.fit([t.encode() for _, t in rows], [languages.index(label) for label, _ in rows], steps)


SCORED = "id long, lang_pred string, score double"


def _blocks(texts, most=1_000_000):
    """Runs of texts of at most so many bytes; a longer text is cut into parts that are pooled together."""
    run, size = [], 0
    for i, text in enumerate(texts):
        if run and size + len(text) > most:
            yield run
            run, size = [], 0
        run.append(i)
        size += len(text)
    if run:
        yield run


def _predict(network):
    def run(batches):
        for rows in batches:
            texts = rows.column(1).to_pylist()
            named, scores = ["und"] * len(texts), [0.0] * len(texts)
            lettered = [i for i, t in enumerate(texts) if t and network and LETTER.search(t)]
            data = [texts[i].encode() for i in lettered]
            for block in _blocks(data):
                parts = [(n, data[n][at : at + 1_000_000]) for n in block for at in range(0, len(data[n]), 1_000_000)]
                chances = network.pooled([p for _, p in parts])
                sums = {}
                for (n, part), chance in zip(parts, chances):
                    sums[n] = sums.get(n, 0) + chance * len(part)
                for n, total in sums.items():
                    share = total / len(data[n])
                    best = int(share.argmax())
                    named[lettered[n]] = network.languages[best]
                    scores[lettered[n]] = float(min(1, max(0, share[best])))
            yield batch(SCORED, rows.column(0), pa.array(named, pa.string()), scores)

    return run


def predict(frame, network, id="doc_id", text="text"):
    """The language of each whole text: the identifier, lang_pred and score.

    Every byte gets a chance for each language from the states of both
    directions; the score is the mean chance of the named language. A text
    that is null, empty or without any letter is `und` with score 0, and so is
    every text if no label was there to learn from. Rows may repeat; only the
    two columns are read; an empty table gives none. There is no shuffle.
    """
    rows = id_and_text(frame, id, text).select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(_predict(network), SCORED).withColumnRenamed("id", id)


def identify(frame, id="doc_id", text="text", lang="lang", **settings):
    """Train on the labelled rows of the frame and predict all: the identifier, held_out, lang_pred and score."""
    network = train(frame, id, text, lang, **settings)
    return predict(frame, network, id, text).select(id, held_out(id).alias("held_out"), "lang_pred", "score")


def keep_known(frame, id="doc_id", text="text", lang="lang", least=0.5, **settings):
    """The rows of the frame whose language is recognised with a score of at least `least`; texts without letters go. Rows that share an identifier stay if one does."""
    network = train(frame, id, text, lang, **settings)
    rejected = predict(frame, network, id, text).groupBy(id).agg(F.max(F.when(F.col("lang_pred") != "und", F.col("score"))).alias("s"))
    rejected = rejected.filter(F.col("s").isNull() | (F.col("s") < least)).select(F.col(id).alias("_rejected"))
    return frame.join(rejected, frame[id].eqNullSafe(rejected["_rejected"]), "left_anti")
