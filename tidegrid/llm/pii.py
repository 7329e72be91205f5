"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds spans to theirs."""

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import functions as F

from tidegrid.llm.support import batch, hashed_sample, id_and_text

KINDS = ("email", "ip", "card", "phone")

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
# A match begins where a run of digits does; the possessive forms spare long runs a second look.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _digits(text):
    return [c for c in text if "0" <= c <= "9"]


def _emails(text):
    """Leftmost matches: the run of allowed characters before an @ that a domain follows."""
    end = 0
    for found in DOMAIN.finditer(text):
        at = found.start()
        begin = at
        # Step back in doubling slices to the start of the run.
        step = 64
        while begin > end:
            low = max(end, begin - step)
            other = None
            for other in NOT_LOCAL.finditer(text, low, begin):
                pass
            if other:
                begin = other.end()
                break
            begin, step = low, step * 2
        if begin < at:
            end = found.end()
            yield begin, end


def base_spans(text):
    """(kind, start, end) of the fixed patterns, by kind and start."""
    spans = []
    if "@" in text:
        spans += [("email", a, b) for a, b in _emails(text)]
    for found in IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in found.group().split(".")):
            spans.append(("ip", found.start(), found.end()))
    for found in CARD.finditer(text):
        digits = _digits(found.group()) if found.end() - found.start() <= 64 else []
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", found.start(), found.end()))
    if "+" in text:
        for found in PHONE.finditer(text):
            if 9 <= len(_digits(found.group())) <= 15:
                spans.append(("phone", found.start(), found.end()))
    return spans


# Candidate regions: what stands, between white space, around a digit or @, over single spaces.
HIT = re.compile(r"[0-9@]\S*+")
REACH = 64  # characters of a region before its first digit or @
TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|\s|.", re.DOTALL)
LONGEST = 16  # tokens of an entity
MARKS = "@.-+() _%"


def regions(text):
    """(start, end) of the stretches in which the field looks for entities."""
    out = []
    for hit in HIT.finditer(text):
        begin = hit.start()
        low = max(out[-1][1] if out else 0, begin - REACH)
        before = text[low:begin]
        cut = max((i for i, c in enumerate(before) if c.isspace()), default=-1) + 1
        begin = low + cut
        if out and (begin == out[-1][1] or begin == out[-1][1] + 1 and text[out[-1][1]] == " "):
            out[-1] = out[-1][0], hit.end()
        else:
            out.append((begin, hit.end()))
    return out


def shape(text):
    """The text with digits and letters made alike; features look at nothing else."""
    return re.sub(r"[^\W\d_]", "a", re.sub(r"[0-9]", "0", text))


def _bucket(n):
    return n if n < 20 else 20 + min(n // 10, 9)


def features(form, cuts, i, j):
    """Whole-span features of the tokens i..j of a region."""
    span = form[cuts[i] : cuts[j]]
    digits = span.count("0")
    before = form[cuts[i] - 1] if cuts[i] else "^"
    after = form[cuts[j]] if cuts[j] < len(form) else "$"
    marks = "".join(m for m in MARKS if m in span)
    letters = "a" in span
    runs = re.sub(r"0+", "0", re.sub(r"a+", "a", span))
    return (
        f"runs={runs}" if len(runs) <= 24 else "runs=long",
        f"digits={_bucket(digits)},{letters}",
        f"marks={marks},{letters}",
        f"first={span[0]},{before in '0a'}",
        f"last={span[-1]},{after in '0a'}",
        f"around={before}|{after}",
        f"dots={min(span.count('.'), 4)},at={min(span.count('@'), 2)},{letters}",
    )


class Field:
    """Weights of whole-span features by kind; a token outside entities scores nothing."""

    def __init__(self):
        self.names = {}
        self.weights = np.zeros((0, len(KINDS)))

    def _ids(self, form, cuts, grow):
        """Candidate segments (i, j, feature ids): they hold a digit or @ and do not begin or end with white space."""
        out = []
        n = len(cuts) - 1
        for i in range(n):
            if form[cuts[i]].isspace():
                continue
            for j in range(i + 1, min(n, i + LONGEST) + 1):
                span = form[cuts[i] : cuts[j]]
                if span[-1].isspace() or not ("0" in span or "@" in span):
                    continue
                if grow:
                    out.append((i, j, [self.names.setdefault(f, len(self.names)) for f in features(form, cuts, i, j)]))
                else:
                    out.append((i, j, [self.names[f] for f in features(form, cuts, i, j) if f in self.names]))
        return out

    def fit(self, examples, rounds=12, rate=0.3):
        """Maximum likelihood of the labelled segmentations, by gradients from forward and backward sums."""
        data = []
        for form, gold, count in examples:
            cuts = _cuts(form)
            places = {c: n for n, c in enumerate(cuts)}
            labels = {(places[a], places[b]): k for k, a, b in gold if a in places and b in places}
            segments = self._ids(form, cuts, True)
            if segments:
                data.append((len(cuts) - 1, segments, labels, count))
        self.weights = np.full((len(self.names), len(KINDS)), -0.2)
        squares = np.full(self.weights.shape, 1e-6)
        for _ in range(rounds):
            slope = 0.001 * self.weights
            for n, segments, labels, count in data:
                scores = np.array([self.weights[f].sum(0) for _, _, f in segments])
                ahead = np.full(n + 1, -np.inf)
                ahead[0] = 0
                by_end, by_start = [[] for _ in range(n + 1)], [[] for _ in range(n + 1)]
                sums = np.logaddexp.reduce(scores, axis=1)
                for s, (i, j, _) in enumerate(segments):
                    by_end[j].append((i, s))
                    by_start[i].append((j, s))
                for j in range(1, n + 1):
                    ahead[j] = np.logaddexp.reduce([ahead[j - 1], *(ahead[i] + sums[s] for i, s in by_end[j])])
                behind = np.full(n + 1, -np.inf)
                behind[n] = 0
                for i in range(n - 1, -1, -1):
                    behind[i] = np.logaddexp.reduce([behind[i + 1], *(behind[j] + sums[s] for j, s in by_start[i])])
                for s, (i, j, f) in enumerate(segments):
                    expected = np.exp(np.minimum(ahead[i] + scores[s] + behind[j] - ahead[n], 0))
                    if (kind := labels.get((i, j))) is not None:
                        expected[KINDS.index(kind)] -= 1
                    slope[f] += count * expected
            squares += slope * slope
            self.weights -= rate * slope / np.sqrt(squares)
        return self

    def decode(self, form):
        """The best segmentation: (kind, start, end) of its entities. Segments are at most LONGEST tokens long."""
        cuts = _cuts(form)
        n = len(cuts) - 1
        best, back = np.zeros(n + 1), [None] * (n + 1)
        by_end = [[] for _ in range(n + 1)]
        for i, j, f in self._ids(form, cuts, False):
            if f:
                scores = self.weights[f].sum(0)
                kind = int(scores.argmax())
                if scores[kind] > 0:
                    by_end[j].append((i, kind, scores[kind]))
        for j in range(1, n + 1):
            best[j] = best[j - 1]
            for i, kind, score in by_end[j]:
                if best[i] + score > best[j]:
                    best[j], back[j] = best[i] + score, (i, kind)
        spans, j = [], n
        while j:
            if back[j]:
                i, kind = back[j]
                spans.append((KINDS[kind], cuts[i], cuts[j]))
                j = i
            else:
                j -= 1
        return spans[::-1]


def _cuts(form):
    return [m.start() for m in TOKEN.finditer(form)] + [len(form)]


def examples(texts):
    """Regions with the segmentation that the fixed patterns give them; equal forms once, with their count."""
    counts = {}
    for text in texts:
        spans = base_spans(text)
        for begin, end in regions(text):
            inside = tuple((k, a - begin, b - begin) for k, a, b in spans if begin <= a and b <= end)
            if end - begin <= 400:
                key = shape(text[begin:end]), inside
                counts[key] = counts.get(key, 0) + 1
    return [(form, gold, np.log1p(n)) for (form, gold), n in sorted(counts.items())]


def train(frame, id="doc_id", text="text", documents=2000, forms=600):
    """A field fitted on at most `documents` texts that hold a digit or @, and `forms` regions of theirs.

    The labels are those of the fixed patterns; the sample is the first
    documents by a hash of the identifier, so it is the same on every run.
    """
    rows = id_and_text(frame, id, text).filter(F.col(text).rlike("[0-9@]") & (F.length(text) < 20_000))
    rows = hashed_sample(rows, "pii", documents, id, text)
    found = examples([r[0] for r in rows.select(text).collect()])
    found.sort(key=lambda e: (-e[2], e[0]))
    return Field().fit(found[:forms])


def plausible(kind, text):
    """The checks of the fixed patterns on a span that the field adds."""
    digits = _digits(text)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "ip":
        return re.fullmatch(r"[0-9]+(\.[0-9]+){3}", text) is not None and all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in text.split("."))
    return "@" in text


def find(text, decode):
    """(base spans, all spans): the field's spans join where they touch none of the others and pass the checks."""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    starts = np.array([a for a, _ in taken], np.int64)
    reach = np.maximum.accumulate([b for _, b in taken]) if taken else starts
    added = []
    for begin, end in regions(text):
        for kind, a, b in decode(shape(text[begin:end])):
            a, b = a + begin, b + begin
            before = int(np.searchsorted(starts, b)) - 1
            if (before < 0 or reach[before] <= a) and plausible(kind, text[a:b]):
                added.append((kind, a, b))
    everything = sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return base, everything


def _joined(spans):
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


SPANS = "id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string"


def _run(field):
    def run(batches):
        decode = lru_cache(maxsize=50_000)(field.decode)
        for rows in batches:
            out = []
            for text in rows.column(1).to_pylist():
                base, everything = find(text, decode)
                counts = [sum(s[0] == kind for s in base) for kind in KINDS]
                out.append((*counts, _joined(base), _joined(everything)))
            if out:
                yield batch(SPANS, rows.column(0), *zip(*out))

    return run


def spans(frame, field, id="doc_id", text="text"):
    """The personal data of each whole text: counts and spans (kind:start:end) of the fixed patterns, and all spans.

    Positions are code points, the end exclusive; spans stand by kind (email,
    ip, card, phone) and start, joined by commas. A null or empty text has
    none. Rows may repeat; other columns are not read; an empty table gives
    none. There is no shuffle.
    """
    rows = id_and_text(frame, id, text).select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(_run(field), SPANS).withColumnRenamed("id", id)


def detect(frame, id="doc_id", text="text", **settings):
    """Fit the field on the frame and apply it to all of it."""
    return spans(frame, train(frame, id, text, **settings), id, text)


def mask(text, found):
    """The text with each span replaced by its kind in brackets."""
    out, end = [], 0
    for kind, a, b in sorted(found, key=lambda s: s[1:]):
        if a >= end:
            out += [text[end:a], f"[{kind}]"]
            end = b
    return "".join([*out, text[end:]])
