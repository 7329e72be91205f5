"""Each operator against a brute-force version on small tables, and on awkward rows."""

import base64
import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from tidegrid.llm import ann, bpe, exact, langid, mixing, pii, simhash, spans, suffix, support, toxicity

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, bucket int, key string, kept string, _dropped int, rep int, label int"

rng = random.Random(4)
VOCABULARY = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) + r.choice(["", "", "", ",", ".", ".\n"]) for _ in range(n))


def rows():
    """Copies, near copies, shared passages, nulls in any column, empty and long texts, ties and a repeated row."""
    passage = prose(70, 99)
    texts = [prose(60 + i, i) for i in range(20)]
    texts += [texts[3], texts[3].upper(), texts[3]]
    texts += [t.replace(VOCABULARY[0], "zz").replace(" ", "  ", 1) for t in texts[:8]]
    texts += [prose(20, 50 + i) + ". " + passage + ". " + prose(20, 80 + i) for i in range(4)]
    texts += [None, None, "", "", " ", "\n\t", "a", "one two", "9" * 40, "é" * 60, "x" * 3000, "!?;", "a\x1cb  c \n d"]
    texts += [prose(9000, 7), "z " * 2000, "ab" * 500]
    texts += ["mail bob.x@mail.example.com, 10.0.0.1 or +1 (838) 555-7439 and 4111 1111 1111 1111.", "@x @a.b a@b 1.2.3 999.1.1.1 +12"]
    out = [(i, t, "ab"[i % 2], f"src{i % 12}", None, None, 1, "k", None, 2, 3, 4) for i, t in enumerate(texts)]
    out.append(out[0])
    out.append((500, "no language. " * 20, None, None, 7, "7", None, None, "", None, None, None))
    out.append((None, "no identifier here at all " * 5, "a", "src0", None, None, None, None, None, None, None, None))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def by_id(found, id="doc_id"):
    return {r[id]: r for r in found.collect()}


def test_bpe(frame):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    known = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = by_id(bpe.round_trip(frame, PATH, PATTERN, ids=True))
    assert len(found) == len({r[0] for r in rows()})
    for row in rows():
        ids = np.array(known.encode_ordinary(row[1] or ""), "<u4")
        assert bytes(found[row[0]].ids) == ids.tobytes()
        assert found[row[0]].n_tokens == len(ids)
        assert found[row[0]].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert found[row[0]].decoded_sha256 == hashlib.sha256((row[1] or "").encode()).hexdigest()
    encoded = bpe.encode(frame, PATH, PATTERN)
    assert {bytes(r.decoded) for r in bpe.decode(encoded, PATH, PATTERN).collect()} == {(r[1] or "").encode() for r in rows()}


def test_bpe_on_random_text():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    known = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    with open(PATH, "rb") as file:
        corpus = bpe.Corpus(bpe.merges(file.read(), PATTERN))
    texts = ["".join(rng.choice(" \n\tabth's1!é😀 th") for _ in range(rng.randrange(60))) for _ in range(1500)]
    ids, sizes = corpus.encode(texts)
    for text, run in zip(texts, np.split(ids, np.cumsum(sizes)[:-1])):
        assert run.tolist() == known.encode_ordinary(text)


def test_bpe_on_long_words():
    """Matches of a megabyte: one byte again and again, short periods, and letters at random."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    known = tiktoken.Encoding("whole", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    with open(PATH, "rb") as file:
        tables = bpe.merges(file.read(), PATTERN)
    r = random.Random(6)
    words = [c * n for c in "xae=- 0é" for n in (2, 3, 7, 40, 1001, 4096)]
    words += ["".join(r.choices("abcdehilnorst", k=5_000)), "ab" * 3_000, "aab" * 2_001, "the" * 1_500, "aaé" * 999]
    for word in words:
        ids, sizes = tables.replay([word.encode(), b"", word.encode()])
        expected = known.encode_ordinary(word)
        assert ids.tolist() == 2 * expected and sizes.tolist() == [len(expected), 0, len(expected)]
    for word in ("x" * 1_000_000, "abc" * 330_000, "".join(r.choices("abcdehilnorst", k=1_000_000))):
        ids, _ = tables.replay([word.encode()])
        assert bytes(tables.decode(ids)) == word.encode()


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact(frame, keep):
    groups = collections.defaultdict(list)
    for row in rows():
        groups[lowered(row[1])].append(row[0])
    found = by_id(exact.groups(frame, keep=keep))
    assert exact.groups(frame).count() == len(rows())
    for text, ids in groups.items():
        best = (max if keep == "largest" else min)((i for i in ids if i is not None), default=None)
        for i in ids:
            row = found[i]
            assert (row.keep_id, row.group_size, row.kept) == (best, len(ids), i == best)
            assert row.text_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_trie_splits_edges():
    trie = exact.RadixTrie()
    words = [b"", b"a", b"ab", b"abc", b"abd", b"b", b"abcabc", b"abc"]
    for word in words:
        trie.node(word).owner = word
    assert sorted(trie.owners()) == sorted(set(words))


def fingerprint(text, words):
    found = re.findall("[^\x20\x09-\x0d]+", lowered(text))
    runs = [" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(frame):
    prints = {r[0]: fingerprint(r[1], 3) for r in rows() if r[0] is not None}
    least = dict(zip(prints, prints))
    for _ in prints:
        for one in prints:
            for two in prints:
                if (prints[one] ^ prints[two]).bit_count() <= 3:
                    least[one] = least[two] = min(least[one], least[two])
    found = by_id(simhash.groups(frame))
    assert found.pop(None).fingerprint
    assert {i: (r.fingerprint, r.component_id) for i, r in found.items()} == {i: (f"{prints[i]:016x}", least[i]) for i in prints}


@pytest.mark.parametrize("limit", [2, 10**6])
def test_runs_of_all_sizes_link_alike(monkeypatch, limit):
    monkeypatch.setattr(simhash, "LONG_RUN", limit)
    r = np.random.default_rng(1)
    centre = r.integers(0, 2**63, 1, dtype=np.uint64)
    flips = [sum(1 << int(b) for b in r.choice(32, r.integers(0, 7))) for _ in range(300)]
    prints = np.unique(centre ^ np.array(flips, np.uint64))[:, None]
    pairs = simhash.links_of_runs(np.full(len(prints), 33 << 32, np.int64), prints, 32, 3)

    def classes(pairs):
        least = list(range(len(prints)))
        for _ in range(len(prints)):
            before = list(least)
            for a, b in pairs:
                least[a] = least[b] = min(least[a], least[b])
            if before == least:
                return least

    every = [(a, b) for a in range(len(prints)) for b in range(a) if simhash._near(prints[a], prints[b], 3)]
    assert all(simhash._near(prints[a], prints[b], 3) for a, b in pairs)
    assert classes(pairs.tolist()) == classes(every)


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 102), (102, 101), (7, 7)] + [(200, i) for i in range(201, 240)]
    found = {r.node: r.least for r in support.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(1, 61)} | {101: 100, 102: 100} | {i: 200 for i in range(201, 240)}


def fill(children, budget):
    """Whole shares by repeated division of what the full ones leave."""
    full, left = {}, budget
    while True:
        weight = sum(w for k, (w, c) in children.items() if k not in full)
        more = {k: c for k, (w, c) in children.items() if k not in full and w and c * weight <= w * left}
        if not more:
            return full, left, weight
        full |= more
        left = budget - sum(full.values())


def test_mixing(frame):
    keys, weights = mixing.production()
    found = mixing.mix(frame, keys, weights, fraction=(3, 4), epochs=2).collect()
    assert len(found) == len(rows())
    words = {r[0]: len((r[1] or "").split()) for r in rows() if r[0] != 500}
    assert all(r.n_tokens == words[r.doc_id] for r in found if r.doc_id in words and r.doc_id is not None and "\x1c" not in (dict((x[0], x[1]) for x in rows())[r.doc_id] or ""))
    total = sum(r.n_tokens for r in found)
    used = sum(r.epochs * r.n_tokens + r.taken for r in found)
    assert used == total * 3 // 4
    leaves = collections.defaultdict(lambda: [0, 0, 0])
    for r in found:
        leaf = leaves[r.domain, r.language, r.origin]
        leaf[0] += r.n_tokens
        leaf[1] += r.epochs * r.n_tokens + r.taken
        leaf[2] = r.leaf_budget
        assert 0 <= r.taken <= r.n_tokens and r.epochs <= 2
    assert all(taken == budget <= 2 * tokens for tokens, taken, budget in leaves.values())
    domains = {d: (w, 2 * sum(v[0] for k, v in leaves.items() if k[0] == d)) for d, w in mixing.DOMAINS.items()}
    full, left, weight = fill(domains, total * 3 // 4)
    for d, (w, _) in domains.items():
        got = sum(v[1] for k, v in leaves.items() if k[0] == d)
        assert got == full[d] if d in full else abs(got - left * w / weight) <= 1


def test_spans(frame):
    first, cuts = {}, {}
    texts = {r[0]: r[1] or "" for r in rows() if r[0] is not None}
    for i in sorted(texts):
        cuts[i] = spans.sentences(texts[i])
        for a, _, h in spans.spans(cuts[i], 3, 12):
            first.setdefault(h, (i, a))
    found = by_id(spans.remove_repeats(frame, words=12))
    for i, text in texts.items():
        gone = set()
        for a, b, h in spans.spans(cuts[i], 3, 12):
            if first[h] != (i, a):
                gone.update(range(a, b))
        kept, end = "", 0
        for n, (start, stop, _) in enumerate(cuts[i]):
            if n in gone:
                kept += text[end:start]
                end = stop
        assert (found[i].n_removed, found[i].kept) == (len(gone), kept + text[end:])
    # The shared passage of 70 words goes from all but the first.
    shared = sorted(i for i, t in texts.items() if prose(70, 99) in t)
    assert found[shared[0]].n_chars_removed == 0 and all(found[i].n_chars_removed > 200 for i in shared[1:])
    assert found[None].n_removed == 0


def test_sentences_of_many_texts_at_once():
    """A group of texts is cut, and has the spans, that each text has by itself."""
    r = random.Random(5)
    parts = ["a", "b ", "İc ", "d. ", "e!? ", "\n", " ", "\u3000", "g ", "𝒳 ", "k ", ".\n", "\x85", "Σ ", "m "]
    for _ in range(400):
        texts = ["".join(r.choices(parts if r.random() < 0.5 else parts[8:11], k=r.choice([0, 3, 40, 300]))) for _ in range(r.randrange(1, 6))]
        group = spans.Group(texts, 3, 10)
        edges = group.total.tolist()
        for text, low, high, begin in zip(texts, group.low.tolist(), group.high.tolist(), group.begins.tolist()):
            expected, words = spans.sentences(text), text.lower().split()
            found = [(int(group.starts[i]) - begin, int(group.stops[i]) - begin, words[edges[i] - edges[low] : edges[i + 1] - edges[low]]) for i in range(low, high)]
            assert found == expected
            ends = [(i - low, int(group.lasts[i]) - low) for i in range(low, high) if group.valid[i]]
            assert ends == [(a, b) for a, b, _ in spans.spans(expected, 3, 10)]
    long = "word, " * 400_000 + "x" * 1_200_000 + " end"
    group = spans.Group([long], 3, 10)
    assert group.total[-1] == 400_002 and len(np.unique(group.hashes)) == 3


def test_spans_of_rows_that_share_identifiers(spark):
    """Repeated rows are one document; texts under one identifier, and a hot passage over many partitions, are each judged."""
    passage = " ".join(f"w{i} x{i} y{i} z{i}." for i in range(9))
    texts = [(1, passage)] * 3 + [(1, "Other words stand here. " + passage), (None, passage), (5, None)]
    texts += [(i, f"Only {i} is new. " + passage) for i in range(10, 400)] + [(399, f"Only 399 is new. {passage}")]
    found = spans.remove_repeats(spark.createDataFrame(texts, "doc_id long, text string").repartition(7), words=10)
    got = sorted({(r.doc_id if r.doc_id is not None else -1, r.n_removed, r.kept.strip()) for r in found.collect()})
    expected = {(-1, 0, passage), (1, 0, passage), (1, 9, "Other words stand here."), (5, 0, "")}
    assert got == sorted(expected | {(i, 9, f"Only {i} is new.") for i in range(10, 400)})
    assert found.count() == len(texts)


def test_spans_inside_long_sentences(spark):
    """A passage of 55 words without a full stop is found at any offset in a sentence."""
    r = random.Random(8)
    fresh = lambda n: [r.choice(VOCABULARY) + str(r.randrange(10**6)) for _ in range(n)]
    passage = fresh(55)
    texts = [(i, " ".join(fresh(20 + i) + passage + fresh(70 - i))) for i in range(40)]
    found = by_id(spans.remove_repeats(spark.createDataFrame(texts, "doc_id long, text string"), words=10))
    assert found[0].n_removed == 0 and found[0].kept == texts[0][1]
    for i, text in texts[1:]:
        left = set(found[i].kept.split())
        assert len(left & set(passage)) <= 27 and left >= set(text.split()) - set(passage)
    assert spans.cuts(["z"] * 40) == [0, 1, 17, 33]


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            double = sum(d if n % 2 == 0 else sum(divmod(2 * d, 10)) for n, d in enumerate(reversed(digits)))
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and double % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }
            if good[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_on_random_text():
    for _ in range(6000):
        text = "".join(rng.choice("aZ@@..-+ ()12345678900 é") for _ in range(rng.randrange(50)))
        assert pii.base_spans(text) == plain_spans(text), text
    card = "4111 1111-11111111"
    assert pii.base_spans(f"x {card} 256.1.1.1 1.2.3.4.5") == plain_spans(f"x {card} 256.1.1.1 1.2.3.4.5")


def test_pii(frame):
    found = by_id(pii.detect(frame))
    for row in rows():
        base = plain_spans(row[1] or "")
        counts = collections.Counter(k for k, _, _ in base)
        got = found[row[0]]
        assert (got.n_email, got.n_ip, got.n_card, got.n_phone) == tuple(counts[k] for k in pii.KINDS)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert got.base == joined
        assert set(joined.split(",")) - {""} <= set(got.spans.split(","))
    assert pii.mask("a b@c.de f", [("email", 2, 8)]) == "a [email] f"


def test_checks_of_added_spans():
    good = [("ip", "1.2.3.255"), ("ip", "001.2.3.4"), ("phone", "123 456 789"), ("card", "4111-1111 1111 1111"), ("email", "a@b")]
    bad = [("ip", "1.2.3"), ("ip", "12"), ("ip", "1.2.3.²"), ("ip", "1.2.3.256"), ("ip", "1.2.3." + "9" * 5000), ("ip", "1..2.3"), ("phone", "12345678"), ("card", "4111-1111 1111 1112")]
    assert all(pii.plausible(*s) for s in good) and not any(pii.plausible(*s) for s in bad)


def test_field_finds_the_best_segmentation():
    texts = [f"call +1 (838) 555-{i:04d} or write to bob{i}@mail{i % 7}.example.com from 10.1.{i}.7 now" for i in range(60)]
    field = pii.Field().fit(pii.examples(texts))
    text = "call +1 (838) 555-1234 or write to bob5@mail3.example.com from 10.1.5.7 now"
    form = pii.shape(text)
    found = [s for a, b in pii.regions(text) for s in [(k, x + a, y + a) for k, x, y in field.decode(form[a:b])]]
    assert sorted(found) == sorted(plain_spans(text))

    def every(form, cuts, at=0):
        if at == len(cuts) - 1:
            return [0.0]
        out = every(form, cuts, at + 1)
        for i, j, f in field._ids(form, cuts, False):
            if i == at and f:
                out += [field.weights[f].sum(0).max() + rest for rest in every(form, cuts, j)]
        return out

    for form in ("a@a.a", "+0 (00", "00.0.0"):
        cuts = pii._cuts(form)
        score = sum(field.weights[[field.names[f] for f in pii.features(form, cuts, cuts.index(a), cuts.index(b)) if f in field.names]].sum(0).max() for _, a, b in field.decode(form))
        assert score == pytest.approx(max(every(form, cuts)))


def test_toxicity(spark, frame):
    bad = ["worthless", "moron", "vile scum"]
    texts = [(i, prose(80, i) + (" " + " ".join([bad[i % 3], prose(4, i), bad[(i + 1) % 3]]) + " " + prose(30, -i) if i % 4 == 0 else "")) for i in range(1000, 1600)]
    documents = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in texts] + [(None, 1), (3, None)], "doc_id long, toxic int")
    found = toxicity.score(documents, toxicity.train(documents, labels)).filter("held_out").collect()
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in found]) > 0.9
    model = toxicity.train(documents, labels)
    awkward = toxicity.score(frame, model).collect()
    assert len(awkward) == len(rows()) and all(0 <= r.score <= 1 for r in awkward)
    assert toxicity.train(documents, labels.limit(0)) is None
    assert {r.score for r in toxicity.score(frame, None).collect()} == {0.0}


def vectors(spark, extra=()):
    r = np.random.default_rng(3)
    centres = r.normal(size=(12, 16))
    points = [(i, (centres[i % 12] + 0.4 * r.normal(size=16)).astype(np.float32).tolist()) for i in range(900)]
    points += [(2000 + i, points[5][1]) for i in range(60)]
    return spark.createDataFrame(points + list(extra), "vec_id long, embedding array<float>"), points


def test_nearest(spark):
    awkward = [(5000, None), (5020, [0.0] * 16), (5040, [1.0, None] * 8), (5060, [float("nan")] * 16), (5080, [1.0]), (None, [1.0] * 16)]
    frame, points = vectors(spark, awkward)
    frame = frame.unionByName(frame.limit(3))
    found = collections.defaultdict(list)
    for r in ann.search(frame, lambda id: id % 20 == 0, k=20, parts=16).collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    table = np.array([p for _, p in points], np.float32).astype(float)
    ids = np.array([i for i, _ in points])
    assert set(found) == {i for i in ids.tolist() if i % 20 == 0}
    hits = 0
    for query, got in found.items():
        scores = (table * table[ids.tolist().index(query)]).sum(1)
        best = sorted((-s, i) for s, i in zip(scores.tolist(), ids.tolist()) if i != query)[:20]
        got.sort()
        assert [r for r, _, _ in got] == list(range(1, 21))
        order = [(-s, i) for _, i, s in got]
        assert order == sorted(order)
        hits += len({i for _, i in best} & {i for _, i, _ in got})
    assert hits / (20 * len(found)) >= 0.9


def test_nearest_of_few(spark):
    few = spark.createDataFrame([(i, [float(i + 1), 1.0]) for i in range(0, 60, 20)], "vec_id long, embedding array<float>")
    found = ann.search(few, lambda id: id % 20 == 0).collect()
    assert len(found) == 6 and not any(r.query_id == r.vec_id for r in found)
    assert ann.search(few.limit(0), lambda id: id % 20 == 0).count() == 0


def test_balanced_parts():
    r = np.random.default_rng(0)
    points = r.normal(size=(512, 8)).astype(np.float32)
    label = ann.balanced_parts(ann.neighbour_graph(points, 8), 8, r)
    assert np.bincount(label).tolist() == [64] * 8


def test_network_gradients():
    r = np.random.default_rng(0)
    network = langid.Network(["a", "b"])
    values, owner, counted = langid.windows([b"hello there", b"x" * 100])
    labels = np.array([0, 1])[owner]

    def loss():
        forth, back = range(langid.SPAN), range(langid.SPAN - 1, -1, -1)
        both = np.concatenate([network.ahead.run(values, forth)[0], network.behind.run(values, back)[0]], axis=1)
        scores = (network.out @ both + network.bias).astype(float)
        logs = scores - np.log(np.exp(scores).sum(1, keepdims=True))
        return -(logs[:, labels, np.arange(len(labels))] * counted).sum() / counted.sum()

    found = network.gradients(values, counted, labels)
    for parameter, slope in zip(network.parameters(), found):
        for place in [tuple(r.integers(0, s) for s in parameter.shape) for _ in range(6)]:
            if parameter.shape[-1] == langid.PAD + 1 and place[1] == langid.PAD:
                continue
            old = parameter[place]
            parameter[place] = old + 1e-2
            up = loss()
            parameter[place] = old - 1e-2
            down = loss()
            parameter[place] = old
            assert slope[place] == pytest.approx((up - down) / 2e-2, abs=2e-3)


def test_language(spark, frame):
    r = random.Random(9)
    letters = {"one": "abcde", "two": "cdefg"}
    text = lambda lang: " ".join("".join(r.choice(letters[lang]) for _ in range(5)) for _ in range(40))
    texts = [(i, text(lang), lang) for i in range(400) for lang in [("one", "two")[i % 2]]] + [(900, "12 ?", "one"), (901, None, "one"), (902, "ééé", None)]
    documents = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    found = langid.identify(documents, steps=60).collect()
    held = [r for r in found if r.held_out and r.doc_id < 900]
    assert np.mean([r.lang_pred == ("one", "two")[r.doc_id % 2] for r in held]) > 0.95
    special = {r.doc_id: r for r in found}
    assert special[900].lang_pred == special[901].lang_pred == "und" and special[902].lang_pred in letters
    kept = {r.doc_id for r in langid.keep_known(documents, steps=60, least=0.3).collect()}
    assert kept == {i for i, _, _ in texts} - {900, 901}
    assert langid.identify(documents.withColumn("lang", F.lit(None).cast("string"))).filter("lang_pred <> 'und'").count() == 0


def test_suffix_array():
    for _ in range(800):
        text = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randrange(40))]
        assert suffix.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("size", [150_000, 2_000])
def test_repeated_bytes(frame, monkeypatch, size):
    monkeypatch.setattr(suffix, "ARRAY", size)
    texts = {r[0]: (r[1] or "").encode() for r in rows() if r[0] is not None}
    first = {}
    for i in sorted(texts):
        for a in range(len(texts[i]) - 49):
            first.setdefault(texts[i][a : a + 50], i)
    found = by_id(suffix.remove_repeats(frame))
    for i, body in texts.items():
        gone = np.zeros(len(body), bool)
        for a in range(len(body) - 49):
            if first[body[a : a + 50]] < i:
                gone[a : a + 50] = True
        kept = bytes(b for b, g in zip(body, gone) if not g)
        runs = int((np.diff(np.append(False, gone).astype(int)) == 1).sum())
        row = found[i]
        assert (row.n_bytes, row.n_removed, row.n_spans, bytes(row.kept)) == (len(body), int(gone.sum()), runs, kept), i
    assert found[None].n_removed == 0


def test_packed_anchors_take_few_bytes():
    """Besides its hashes of twelve bytes, an anchor takes less than five, its share of the identifiers included."""
    r = random.Random(12)
    texts = [bytes(r.choices(range(256), k=2000)) for _ in range(400)]
    texts[7] = texts[300] = texts[5]
    ids = np.arange(400) * 7 + 10**12
    packed = [row for b in suffix._packed(ids, 50, 20, 64, [(i, 0, t) for i, t in enumerate(texts)]) for row in b.to_pylist()]
    data, ends = np.frombuffer(b"".join(texts), np.uint8), np.arange(1, 401) * 2000
    anchors = len(suffix.anchors(data, ends - 2000, ends, 50, 20)[0])
    assert sum(len(v) for row in packed for v in row.values() if isinstance(v, bytes)) < 17 * anchors
    met = [suffix._meet([row]) for row in packed]
    found = {id: 0 for id in ids}
    for rows in met:
        for row in rows.to_pylist() if rows else []:
            found[row["id"]] += row["high"] + 1 - row["low"]
    assert {id for id, count in found.items() if count} == {ids[7], ids[300]}
    assert found[ids[7]] == found[ids[300]] == 1951


def test_identifiers_of_any_size_and_order(spark):
    """Differences of identifiers may wrap around."""
    ids = [5, -(2**63), 2**63 - 1, 0, 2**40, -7]
    texts = [("a copy " * 40 if i != 0 else prose(50, 1), i) for i in ids]
    found = by_id(suffix.remove_repeats(spark.createDataFrame(texts, "text string, doc_id long").repartition(1)))
    assert {i: found[i].n_removed for i in ids} == {i: 0 if i in (0, -(2**63)) else 280 for i in ids}


def test_large_contexts_divide_alike(monkeypatch):
    run = [(i, 7, bytes(rng.choice(b"ab") for _ in range(5)) + b"c" * 50 + bytes(rng.choice(b"ab") for _ in range(4))) for i in range(80)]
    whole = sorted(suffix.repeated(run, 50))
    monkeypatch.setattr(suffix, "ARRAY", 900)
    assert sorted(x for part in suffix._blocks_of(run, 50) for x in suffix.repeated(part, 50)) == whole


def test_a_string_of_many_copies_fits_its_arrays(monkeypatch):
    """Contexts around one line in very many documents: bounded arrays give what one array of all gives."""
    monkeypatch.setattr(suffix, "ARRAY", 20_000)
    line, r = b"one line that stands in every document of this table, ok", random.Random(8)
    run = [(i // 2, 5, bytes(r.choices(b"xyz", k=3)) + line + bytes(r.choices(b"xyz", k=2))) for i in range(8_000)]
    parts = suffix._blocks_of(run, 50)
    assert len(parts) > 8 and all(sum(len(body) + 1 for _, _, body in part) <= 20_000 for part in parts)
    first = {}
    strings = [(id, low + i, body[i : i + 50]) for id, low, body in run for i in range(len(body) - 49)]
    for id, _, string in strings:
        first.setdefault(string, id)
    found = sorted({x for part in parts for x in suffix.repeated(part, 50)})
    assert found == sorted({(id, start) for id, start, string in strings if first[string] < id})
    assert {(id, start) for id, low, high in suffix._joined(found) for start in range(low, high + 1)} == set(found)


def test_empty_tables(spark, empty):
    keys, weights = mixing.production()
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    found = [
        bpe.round_trip(empty, PATH, PATTERN),
        exact.groups(empty),
        exact.dedup(empty),
        mixing.mix(empty, keys, weights),
        spans.remove_repeats(empty),
        pii.detect(empty),
        toxicity.score(empty, toxicity.train(empty, labels)),
        simhash.groups(empty),
        simhash.dedup(empty),
        langid.identify(empty),
        langid.keep_known(empty),
        suffix.remove_repeats(empty),
    ]
    assert [f.count() for f in found] == [0] * len(found)


def test_only_judged_copies_go(spark):
    copy, other = prose(60, 700), prose(60, 701)
    table = [(None, copy), (None, other), (None, prose(60, 702)), (1, copy), (2, prose(60, 703)), (2, prose(60, 704)), (3, prose(60, 705)), (3, other.upper()), (4, other)]
    table += [(5, prose(60, 703)), (0, prose(60, 703))]
    frame = spark.createDataFrame(table, "doc_id long, text string")
    kept = lambda found: sorted(((r.doc_id, r.text) for r in found.collect()), key=repr)
    # The largest identifier stays, and the other texts of null, 2 and 3 are no copies.
    assert kept(exact.dedup(frame)) == sorted([table[i] for i in (2, 3, 5, 6, 8, 9)], key=repr)
    # The smallest stays; a row without identifier too.
    expected = sorted([table[i] for i in (0, 1, 2, 3, 5, 6, 7, 10)], key=repr)
    assert kept(simhash.dedup(frame)) == expected
