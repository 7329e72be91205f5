"""Toxicity by compression distance between two zstandard dictionaries."""

import numpy as np
import zstandard
from pyspark.sql import functions as F

from tidegrid.llm.langid import held_out
from tidegrid.llm.support import batch, id_and_text

WINDOW = 8  # words
LONGEST = 512  # bytes of a window; longer ones are cut
LEVEL = 9
COMMON = 110_000  # bytes of ordinary text that both dictionaries end with
FIRST, FINAL = 16_000, 3_000  # bytes that tell the two apart, at first and after refinement
SLICE = 8_000  # characters of a sampled text


def windows(text):
    """The words of a text, lower-cased, eight at a time."""
    words = text.lower().encode().split()
    out = []
    for i in range(0, len(words), WINDOW):
        window = b" ".join(words[i : i + WINDOW])
        out.extend(b" " + window[j : j + LONGEST] + b" " for j in range(0, len(window), LONGEST))
    return out


def dictionary(samples, size, segment, match):
    """The bytes of a dictionary trained on the samples; where they are too few for that, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=match).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size] or b" " * 16


def compressor(content):
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False)


def gains(pieces, toxic, ordinary):
    """By how many bytes the toxic dictionary compresses each window better."""
    return np.array([len(ordinary.compress(p)) - len(toxic.compress(p)) for p in pieces], float)


def measures(gain):
    """What the thresholds are calibrated on: the strongest windows, the mean, and the share of strong ones."""
    if not len(gain):
        gain = np.zeros(1)
    top = np.sort(gain)[::-1]
    return [top[0], top[:3].sum() / 3, gain.mean(), (gain >= 3).mean(), np.log1p((gain >= 2).sum()), np.log1p((gain >= 3).sum())]


def without_copies(texts):
    """The texts of which little was met before, by runs of four words; copies would pass for what is typical."""
    seen, out = set(), []
    for text in texts:
        words = text.lower().split()
        runs = {" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))}
        if len(runs & seen) <= 0.1 * len(runs):
            out.append(text)
        seen |= runs
    return out


class Model:
    """Two dictionaries, and a logistic threshold on their differences."""

    def fit(self, toxic, ordinary, rounds=2):
        """Dictionaries from two thirds of the texts, refined on the windows they tell apart; thresholds from the rest."""
        own, others = without_copies(toxic[::3] + toxic[1::3]), without_copies(ordinary[::3] + ordinary[1::3])
        half = len(others) // 2
        pieces = lambda texts: list(dict.fromkeys(w for t in texts for w in windows(t)))
        common = dictionary(pieces(others[:half]), COMMON, 24, 8)
        mine, theirs = all_mine, all_theirs = pieces(own), pieces(others[half:])
        for turn in range(rounds + 1):
            size, match = (FINAL, 6) if turn else (FIRST, 8)
            self.toxic = dictionary(mine, size, 16, match) + common
            self.ordinary = dictionary(theirs, size, 16, match) + common
            if turn == rounds:
                break
            one, two = compressor(self.toxic), compressor(self.ordinary)
            gain, loss = gains(all_mine, one, two), gains(all_theirs, one, two)
            sure, doubtful = (np.percentile(loss, [99, 90]) if len(loss) else (3, 0))
            mine = [w for w, g in zip(all_mine, gain) if g >= max(3, sure)] or all_mine
            theirs = [w for w, g in zip(all_theirs, loss) if g >= doubtful] or all_theirs
        one, two = compressor(self.toxic), compressor(self.ordinary)
        rest = toxic[2::3] + ordinary[2::3]
        marks = np.array([1.0] * len(toxic[2::3]) + [0.0] * len(ordinary[2::3]))
        table = np.array([measures(gains(windows(t), one, two)) for t in rest])
        self.mean, self.scale = table.mean(0), table.std(0) + 1e-9
        table = np.column_stack([(table - self.mean) / self.scale, np.ones(len(table))])
        self.weights = np.zeros(table.shape[1])
        for _ in range(40):
            chance = 1 / (1 + np.exp(-np.clip(table @ self.weights, -30, 30)))
            slope = table.T @ (chance - marks) + 0.1 * self.weights
            curve = (table * (chance * (1 - chance))[:, None]).T @ table + 0.1 * np.eye(len(self.weights))
            self.weights -= np.linalg.solve(curve, slope)
        return self

    def score(self, text, toxic, ordinary):
        row = (np.array(measures(gains(windows(text), toxic, ordinary))) - self.mean) / self.scale
        return float(1 / (1 + np.exp(-np.clip(row @ self.weights[:-1] + self.weights[-1], -30, 30))))


def sample(frame, labels, id, text, label, most_toxic, most_ordinary):
    """Bounded labelled texts outside the held-out fifth, the first by a hash of the identifier."""
    marked = labels.filter(F.col(label).isin(0, 1) & F.col(id).isNotNull() & ~held_out(id))
    marked = marked.groupBy(F.col(id).cast("long").alias("id")).agg(F.max(label).alias("toxic")).withColumn("key", F.xxhash64(F.lit("toxic"), "id"))
    pick = lambda value, most: marked.filter(F.col("toxic") == value).orderBy("key", "id").limit(most)
    chosen = pick(1, most_toxic).unionByName(pick(0, most_ordinary))
    rows = frame.filter(F.length(text) > 0).select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    begin = (F.pmod(F.col("key"), F.greatest(F.length("text") - SLICE, F.lit(0)) + 1) + 1).cast("int")
    found = rows.join(F.broadcast(chosen), "id").select("id", "toxic", "key", F.col("text").substr(begin, F.lit(SLICE)).alias("text"))
    found = found.orderBy("key", "id", "text").collect()
    return [r.text for r in found if r.toxic], [r.text for r in found if not r.toxic]


def train(frame, labels, id="doc_id", text="text", label="toxic", most_toxic=1500, most_ordinary=4000):
    """A model fitted on the driver from at most so many texts (slices of 8,000 characters) of each label; None without both."""
    toxic, ordinary = sample(frame, labels, id, text, label, most_toxic, most_ordinary)
    if len(toxic) < 6 or len(ordinary) < 6:
        return None
    return Model().fit(toxic, ordinary)


SCORED = "id long, score double"


def _score(model):
    def run(batches):
        toxic, ordinary = (compressor(model.toxic), compressor(model.ordinary)) if model else (None, None)
        for rows in batches:
            scores = [model.score(t, toxic, ordinary) if model else 0.0 for t in rows.column(1).to_pylist()]
            yield batch(SCORED, rows.column(0), scores)

    return run


def score(frame, model, id="doc_id", text="text", threshold=0.5):
    """The toxicity of each whole text: the identifier, held_out, score (0 to 1) and predicted.

    Windows of eight words are compressed with a dictionary of toxic and one of
    ordinary text, which differ only in what either holds of its own; the
    lengths are compared, and calibrated thresholds turn the differences of all
    windows into a chance. A null or empty text has the score of no difference.
    Without labels of both kinds to learn from every score is 0. Rows may
    repeat; only identifier and text are read; an empty table gives none. There
    is no shuffle.
    """
    rows = id_and_text(frame, id, text).select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    scored = rows.mapInArrow(_score(model), SCORED)
    return scored.select(
        F.col("id").alias(id),
        F.coalesce(held_out("id"), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
