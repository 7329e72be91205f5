"""Approximate nearest neighbours: a partitioned neighbour graph, and a classifier that routes to its parts."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegrid.llm.support import batch, cut, hashed_sample

BLOCK = 4096  # vectors in one packed row of the index
QUERIES = 512  # queries in one packed row


def usable(frame, id, vector):
    """Distinct (id, vector as array<float>) of the rows that take part, all of the most frequent length."""
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = frame.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull() & ~bad & F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vector") == (sizes.n if sizes else 0)).distinct()


def matrix(column):
    """An Arrow list column as a float matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def neighbour_graph(points, degree):
    """The nearest points of each point by inner product, itself left out."""
    degree = min(degree, len(points) - 1)
    found = np.empty((len(points), degree), np.int64)
    for begin in range(0, len(points), 1024):
        scores = points[begin : begin + 1024] @ points.T
        scores[np.arange(len(scores)), np.arange(begin, begin + len(scores))] = -np.inf
        found[begin : begin + 1024] = np.argpartition(-scores, degree - 1, axis=1)[:, :degree]
    return found


def balanced_parts(graph, parts, rng):
    """Parts of equal size that cut few edges: halves at the median of the slowest mode, again and again."""
    n = len(graph)
    edges = np.concatenate([np.column_stack([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()])] * 1)
    edges = np.concatenate([edges, edges[:, ::-1]])
    label = np.zeros(n, np.int64)
    count = 1
    while count < parts:
        inner = edges[label[edges[:, 0]] == label[edges[:, 1]]]
        degree = np.bincount(inner[:, 0], minlength=n) + 1e-9
        mode = rng.normal(size=n)
        for _ in range(60):
            # A random walk inside each part, without the part's mean: what fades last divides it best.
            mode = 0.5 * (mode + np.bincount(inner[:, 0], mode[inner[:, 1]], n) / degree)
            weight = np.bincount(label, degree, count)
            mode -= (np.bincount(label, degree * mode, count) / weight)[label]
            mode /= np.sqrt(np.bincount(label, mode**2, count) + 1e-30)[label]
        order = np.lexsort((mode, label))
        sizes = np.bincount(label, minlength=count)
        place = np.empty(n, np.int64)
        place[order] = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        label = label * 2 + (place >= (sizes // 2)[label])
        count *= 2
    return label


class Router:
    """A small classifier from a vector to the chances of the parts."""

    def __init__(self, points, targets, hidden, steps, rng):
        parts = targets.shape[1]
        scale = np.sqrt(len(points[0])) / max(1e-9, np.abs(points).sum(1).mean() / np.sqrt(len(points[0])))
        self.one = (rng.normal(size=(points.shape[1], hidden)) * scale / np.sqrt(points.shape[1])).astype(np.float32)
        self.shift = np.zeros(hidden, np.float32)
        self.two = (rng.normal(size=(hidden, parts)) / np.sqrt(hidden)).astype(np.float32)
        self.bias = np.zeros(parts, np.float32)
        weights = [self.one, self.shift, self.two, self.bias]
        means, squares = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        for step in range(1, steps + 1):
            pick = rng.integers(0, len(points), 512)
            x = points[pick]
            inner = np.maximum(x @ self.one + self.shift, 0)
            slope = (self._chances(inner) - targets[pick]) / len(pick)
            back = (slope @ self.two.T) * (inner > 0)
            for w, g, mean, square in zip(weights, [x.T @ back, back.sum(0), inner.T @ slope, slope.sum(0)], means, squares):
                mean += 0.1 * (g - mean)
                square += 0.001 * (g * g - square)
                w -= (0.005 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)).astype(np.float32)

    def _chances(self, inner):
        scores = inner @ self.two + self.bias
        scores = np.exp(scores - scores.max(1, keepdims=True))
        return scores / scores.sum(1, keepdims=True)

    def ranked(self, points):
        """Parts by falling chance; equal chances by number."""
        inner = np.maximum(points.astype(np.float32) @ self.one + self.shift, 0)
        return np.argsort(-(inner @ self.two + self.bias), axis=1, kind="stable")


def train(vectors, parts=32, sample=4096, degree=16, hidden=128, steps=600, seed=5):
    """A router fitted on at most `sample` vectors, the first by a hash of the identifier; None without vectors.

    The neighbour graph of the sample is cut into `parts` balanced parts (a
    power of two); each vector's target is where it and its neighbours lie.
    """
    rows = hashed_sample(vectors, "ann", sample, "id", "vector").toArrow()
    points = matrix(rows.column("vector").combine_chunks()).astype(np.float32)
    while parts > 1 and parts * 4 > len(points):
        parts //= 2
    if not len(points):
        return None
    rng = np.random.default_rng(seed)
    if parts == 1:
        return Router(points, np.ones((len(points), 1), np.float32), 1, 0, rng)
    graph = neighbour_graph(points, degree)
    label = balanced_parts(graph, parts, rng)
    targets = np.zeros((len(points), parts), np.float32)
    for column in [label, *label[graph].T]:
        targets[np.arange(len(points)), column] += 1 / (1 + graph.shape[1])
    return Router(points, targets, hidden, steps, rng)


def _exact(queries, points):
    """Inner products in double precision, each summed alike wherever its vectors stand."""
    return (queries.astype(np.float64) * points.astype(np.float64)).sum(-1)


def best(query_ids, queries, ids, points, k):
    """(query, id, score) of the k best of the points for each query, its own row left out, ties to smaller ids."""
    rough = queries.astype(np.float64) @ points.astype(np.float64).T
    rough[query_ids[:, None] == ids[None, :]] = -np.inf
    out = []
    keep = min(k, len(ids))
    edge = -np.partition(-rough, keep - 1, axis=1)[:, keep - 1]
    for row in range(len(query_ids)):
        slack = 1e-9 * max(1.0, abs(edge[row])) if np.isfinite(edge[row]) else 0
        near = np.nonzero((rough[row] >= edge[row] - slack) & (rough[row] > -np.inf))[0]
        scores = _exact(queries[row][None, :], points[near])
        order = np.lexsort((ids[near], -scores))[:keep]
        out.append((np.full(len(order), query_ids[row]), ids[near][order], scores[order]))
    return [np.concatenate(column) for column in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]


FOUND = "query long, id long, score double"


def _routed(router, probes):
    def run(batches):
        for rows in batches:
            points = matrix(rows.column(1)).astype(np.float32)
            parts = router.ranked(points)[:, :probes]
            keys = np.repeat(rows.column(0).to_numpy(), parts.shape[1])
            bodies = np.repeat(np.array([p.tobytes() for p in points], object), parts.shape[1])
            yield batch("id long, part int, body binary", keys, parts.ravel().astype(np.int32), bodies.tolist())

    return run


def _packed(most):
    schema = "part int, ids binary, bodies binary"

    def run(batches):
        part, ids, bodies = None, [], []
        for rows in batches:
            out = []
            for key, where, body in zip(*[rows.column(i).to_pylist() for i in range(3)]):
                if where != part or len(ids) == most:
                    if ids:
                        out.append((part, np.array(ids, np.int64).tobytes(), b"".join(bodies)))
                    part, ids, bodies = where, [], []
                ids.append(key)
                bodies.append(body)
            if out:
                yield batch(schema, *zip(*out))
        if ids:
            yield batch(schema, [part], [np.array(ids, np.int64).tobytes()], [b"".join(bodies)])

    return run, schema


def pack(routed, most, per_part):
    """Rows of at most `most` vectors of one part each; a part's vectors are spread over as many tasks as it needs."""
    run, schema = _packed(most)
    spread = routed.withColumn("slot", F.pmod(F.xxhash64("id"), F.lit(max(1, per_part))))
    return spread.repartition("part", "slot").sortWithinPartitions("part", "slot").select("id", "part", "body").mapInArrow(run, schema)


def _rerank(k):
    def run(batches):
        for rows in batches:
            for qi, qb, di, db in zip(*[rows.column(i).to_pylist() for i in range(4)]):
                query_ids, ids = np.frombuffer(qi, np.int64), np.frombuffer(di, np.int64)
                queries = np.frombuffer(qb, np.float32).reshape(len(query_ids), -1)
                points = np.frombuffer(db, np.float32).reshape(len(ids), -1)
                yield batch(FOUND, *best(query_ids, queries, ids, points, k))

    return run


def _top(found, k):
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _scan(query_ids, queries, k):
    def run(batches):
        for rows in batches:
            if rows.num_rows:
                yield batch(FOUND, *best(query_ids, queries, rows.column(0).to_numpy(), matrix(rows.column(1)), k))

    return run


def brute_force(vectors, query_ids, queries, k):
    """The exact answer for a few given queries: every block of rows gives its k best."""
    return _top(vectors.mapInArrow(_scan(query_ids, queries, k), FOUND), k)


def probes_needed(router, vectors, k, recall, trials, parts):
    """Parts to search so that `trials` held-out rows find the given share of their exact neighbours among all rows."""
    rows = hashed_sample(vectors, "trial", trials, "id", "vector").toArrow()
    ids, points = rows.column("id").to_numpy(), matrix(rows.column("vector").combine_chunks())
    truth = brute_force(vectors, ids, points, k).join(vectors, "id").select("query", "vector").toArrow()
    if not truth.num_rows:
        return parts
    ranks = {key: np.argsort(order) for key, order in zip(ids.tolist(), router.ranked(points))}
    home = router.ranked(matrix(truth.column("vector").combine_chunks()))[:, 0]
    places = np.array([ranks[q][p] for q, p in zip(truth.column("query").to_pylist(), home.tolist())])
    share = np.cumsum(np.bincount(places, minlength=parts)) / len(places)
    return int(np.searchsorted(share, recall)) + 1


def search(frame, queries, id="vec_id", vector="embedding", k=20, recall=0.96, trials=256, **settings):
    """The k nearest rows found of each query, by inner product in double precision.

    `queries` is a condition on the identifier; candidates are all rows but
    the query's own. Returns query_id, rank (from 1), the identifier and score;
    equal scores go to the smaller identifier. Rows without identifier, or with
    a vector that is null, zero, of another length than most, or holds null or
    non-finite components take no part; rows that repeat both count once. Other
    columns are not read. Fewer candidates than k are all returned; an empty
    table gives none.

    Every row is indexed in the part that the classifier finds most probable;
    of equal vectors only the k + 1 smallest identifiers are kept, since no
    other can be among the k nearest. A query searches as many of its most
    probable parts as bounded trials need for `recall`. Parts are cut into
    blocks, so neither a large part nor many queries meet in one task.
    """
    vectors = cut(usable(frame, id, vector))
    order = Window.partitionBy("vector").orderBy("id")
    kept = vectors.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1).drop("n")
    router = train(kept, **settings)
    if router is None:
        return vectors.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias(id), F.lit(0.0).alias("score")).limit(0)
    kept = cut(kept)
    parts = router.two.shape[1]
    probes = probes_needed(router, kept, k, recall, trials, parts) if parts > 1 else 1
    asked = vectors.filter(queries(F.col("id")))
    rows = kept.count()
    schema = "id long, part int, body binary"
    index = pack(kept.mapInArrow(_routed(router, 1), schema), BLOCK, rows // (parts * BLOCK))
    wanted = pack(asked.mapInArrow(_routed(router, probes), schema), QUERIES, asked.count() // (parts * QUERIES))
    pairs = index.withColumnsRenamed({"ids": "di", "bodies": "db"}).join(wanted.withColumnsRenamed({"ids": "qi", "bodies": "qb"}), "part")
    found = _top(pairs.select("qi", "qb", "di", "db").mapInArrow(_rerank(k), FOUND), k)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias(id), "score")
