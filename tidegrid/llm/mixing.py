"""Mixing sources to target weights: hierarchical budgets and token prefixes of seeded epochs."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegrid.llm.support import cut

WHOLE = "decimal(38,0)"
# Digits of the order hash that make the bucket of a document: 65,536 buckets in each leaf.
BUCKET_DIGITS = 4


def words(text):
    """Tokens of a text as runs without ASCII white space; none if it is null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _fill(children, parents, keys, level):
    """Share the budget of each parent among its children.

    `children` has the keys down to `level`, weight and capacity; `parents` the
    keys above it and budget, or for the first level is the one budget. Children whose capacity is below their share get
    all they can use and leave the rest to their siblings, in order of capacity
    by weight; the others divide what is left by weight, to the last token.
    """
    above = keys[:level]
    joined = children.join(parents, above) if above else children.withColumn("budget", F.lit(parents))
    ratio = F.when(F.col("weight") > 0, F.col("capacity").cast("double") / F.col("weight")).otherwise(F.lit(float("inf")))
    order = Window.partitionBy(*above).orderBy("ratio", keys[level])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ahead = order.rowsBetween(0, Window.unboundedFollowing)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast(WHOLE)
    rows = joined.withColumn("ratio", ratio).select(
        *keys[: level + 1],
        "weight",
        "capacity",
        "ratio",
        F.col("budget").cast(WHOLE).alias("budget"),
        F.coalesce(F.sum("capacity").over(before).cast(WHOLE), zero).alias("used"),
        F.sum("weight").over(ahead).cast(WHOLE).alias("open"),
    )
    # Once one child is not full, neither are those after it.
    full = F.col("capacity").cast(WHOLE) * F.col("open") <= F.col("weight").cast(WHOLE) * F.greatest(F.col("budget") - F.col("used"), zero)
    rows = rows.withColumn("full", F.min(full).over(order.rowsBetween(Window.unboundedPreceding, 0)) & (F.col("weight") > 0))
    rest = F.greatest(F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(whole).cast(WHOLE), zero), zero)
    share = F.when(~F.col("full"), F.col("weight"))
    rows = rows.select(
        *keys[: level + 1],
        "full",
        "capacity",
        rest.alias("rest"),
        F.coalesce(F.sum(share).over(before).cast(WHOLE), zero).alias("low"),
        F.coalesce(F.sum(share).over(order.rowsBetween(Window.unboundedPreceding, 0)).cast(WHOLE), zero).alias("high"),
        F.sum(share).over(whole).cast(WHOLE).alias("all"),
    )
    part = F.expr("cast(rest * high div greatest(all, 1) - rest * low div greatest(all, 1) as bigint)")
    return rows.select(*keys[: level + 1], F.when(F.col("full"), F.col("capacity")).otherwise(F.coalesce(part, F.lit(0))).alias("budget"))


def budgets(leaves, keys, weights, total):
    """The token budget of each leaf.

    `leaves` has the key columns, one level of the tree each, and tokens (what
    a leaf can give, all epochs together). `weights` maps each key column to a
    column expression of that level: an integer target weight among siblings,
    at least 0. `total` is the budget of the root.
    """
    parents = total
    for level in range(len(keys)):
        children = leaves.groupBy(*keys[: level + 1]).agg(F.sum("tokens").cast("long").alias("capacity"))
        weight = F.greatest(F.coalesce(weights[keys[level]].cast("long"), F.lit(0).cast("long")), F.lit(0).cast("long"))
        parents = _fill(children.withColumn("weight", weight), parents, keys, level)
    return parents


def select_prefixes(documents, leaves, keys, seed):
    """How much of each document its leaf's budget takes.

    A leaf repeats its documents in epochs, each in an order of its own that
    the seed fixes, until the budget is used: whole epochs, then a prefix of
    the next by tokens. No leaf is put in order as a whole: the order is that
    of a hash, whose first digits make buckets; only the bucket in which the
    prefix ends is sorted.
    """
    joined = documents.join(leaves, keys)
    epoch = F.when(F.col("available") > 0, F.expr("budget div available")).otherwise(F.lit(0))
    rows = joined.withColumn("epochs", epoch.cast("long"))
    rows = rows.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("available"))
    rows = rows.withColumn("place", F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.col("id").cast("string")), 256))
    rows = rows.withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS))
    sizes = rows.groupBy(*keys, "bucket", "rest").agg(F.sum("n_tokens").alias("size"))
    until = F.sum("size").over(Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sizes = sizes.withColumn("until", until).select(*keys, "bucket", (F.col("until") - F.col("size")).alias("begin"), "until")
    rows = rows.join(sizes, [*keys, "bucket"])
    inside = rows.filter("until <= rest").withColumn("taken", F.col("n_tokens"))
    beyond = rows.filter("until > rest AND begin >= rest").withColumn("taken", F.lit(0).cast("long"))
    order = Window.partitionBy(*keys, "bucket").orderBy("place", "id", "n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    split = rows.filter("until > rest AND begin < rest").withColumn("upto", F.col("begin") + F.sum("n_tokens").over(order))
    taken = F.least(F.col("n_tokens"), F.greatest(F.lit(0).cast("long"), F.col("rest") - (F.col("upto") - F.col("n_tokens"))))
    split = split.withColumn("taken", taken).drop("upto")
    return reduce(lambda a, b: a.unionByName(b), [inside, beyond, split])


def mix(frame, keys, weights, fraction=(1, 2), epochs=1, seed=17, id="doc_id", text="text"):
    """The share of each document in a mixture with target weights.

    `keys` maps the names of the tree's levels, from the root down, to column
    expressions of the frame; `weights` maps each name to an integer weight
    expression over the levels down to it. The root's budget is `fraction` (a
    pair of integers) of all tokens there are, and no document is used more
    than `epochs` times.

    One row per row of the frame: the identifier, the levels, n_tokens (words),
    leaf_budget, epochs (full uses), taken (tokens of one more, partial use)
    and selected (any use). A null level is a branch `(null)`; a null or empty
    text has no tokens and is selected only with a full epoch; shortages go to
    siblings first, and to the siblings of the parent only when a whole branch
    is short. Budgets are met to the token unless all sources are exhausted.
    Rows that repeat identifier and text are drawn in an arbitrary order among
    themselves. Other columns are not read; an empty table gives none.
    """
    names = list(keys)
    levels = [F.coalesce(column.cast("string"), F.lit("(null)")).alias(name) for name, column in keys.items()]
    documents = frame.select(F.col(id).alias("id"), words(text).alias("n_tokens"), *levels)
    found = documents.groupBy(*names).agg(F.sum("n_tokens").alias("available"))
    found = cut(found)
    capacity = found.select(*names, (F.col("available") * epochs).alias("tokens"))
    total = found.agg(F.sum("available")).first()[0] or 0
    leaves = cut(budgets(capacity, names, weights, int(total) * int(fraction[0]) // int(fraction[1])).join(found, names))
    rows = select_prefixes(documents, leaves, names, seed)
    return rows.select(
        F.col("id").alias(id),
        *names,
        "n_tokens",
        F.col("budget").cast("long").alias("leaf_budget"),
        "epochs",
        F.col("taken").cast("long").alias("taken"),
        ((F.col("epochs") > 0) | (F.col("taken") > 0)).alias("selected"),
    )


def keep_selected(frame, keys, weights, id="doc_id", text="text", **settings):
    """The rows of the frame that a mixture of one epoch selects, whole: the document in which a prefix ends stays."""
    chosen = mix(frame, keys, weights, id=id, text=text, **settings).filter("selected").select(F.col(id).alias("_chosen")).distinct()
    return frame.join(chosen, frame[id].eqNullSafe(chosen["_chosen"]), "left_semi")


# The production mixture: three domains of the numbered sources, weighted languages, and sources alike.
DOMAINS = {"web": 5, "books": 3, "code": 2}
LANGUAGES = {"en": 6, "de": 2, "fr": 2, "es": 1}


def production():
    """Levels and weights for the documents table: domain (by the number of the source), language, source."""
    number = F.coalesce(F.regexp_extract("source", r"([0-9]+)$", 1).try_cast("int"), F.lit(0))
    domain = F.when(number % 10 < 5, "web").when(number % 10 < 8, "books").otherwise("code")
    weigh = lambda column, table: F.coalesce(F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[F.col(column)], F.lit(1))
    keys = {"domain": domain, "language": F.col("lang"), "origin": F.col("source")}
    return keys, {"domain": weigh("domain", DOMAINS), "language": weigh("language", LANGUAGES), "origin": F.lit(1)}


def production_sql(fraction=(3, 4), epochs=2, seed=17):
    """The production mixture as one SQL statement."""
    case = lambda column, table: f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in table.items()) + " ELSE 1 END"
    names = ["domain", "language", "origin"]
    weights = [case("domain", DOMAINS), case("language", LANGUAGES), "1"]
    parts = [
        """d0 AS (SELECT doc_id, lang, source, text, coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER), 0) % 10 AS number
        FROM documents),
        d AS (SELECT doc_id, CASE WHEN number < 5 THEN 'web' WHEN number < 8 THEN 'books' ELSE 'code' END AS domain,
        coalesce(lang, '(null)') AS language, coalesce(source, '(null)') AS origin,
        len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\v\\f\\r]+'))::HUGEINT AS n_tokens FROM d0),
        leaf AS (SELECT domain, language, origin, sum(n_tokens)::HUGEINT AS available FROM d GROUP BY ALL)""",
        f"b AS (SELECT coalesce(sum(available) * {fraction[0]} // {fraction[1]}, 0)::HUGEINT AS budget FROM leaf)",
    ]
    parent = "b"
    for level, name in enumerate(names):
        keys, above = ", ".join(names[: level + 1]), names[:level]
        join = f"JOIN {parent} p USING ({', '.join(above)})" if above else f"CROSS JOIN {parent} p"
        by = f"PARTITION BY {', '.join(above)} " if above else ""
        order = f"{by}ORDER BY ratio, {name} ROWS BETWEEN"
        parts.append(f"""c{level} AS (SELECT {keys}, sum(available)::HUGEINT * {epochs} AS capacity, ({weights[level]})::HUGEINT AS weight FROM leaf GROUP BY {keys}),
        q{level} AS (SELECT c.*, p.budget, CASE WHEN weight > 0 THEN capacity::DOUBLE / weight ELSE 'inf'::DOUBLE END AS ratio FROM c{level} c {join}),
        r{level} AS (SELECT *, coalesce(sum(capacity) OVER ({order} UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS used,
          sum(weight) OVER ({order} CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS open FROM q{level}),
        f{level} AS (SELECT *, bool_and(capacity * open <= weight * greatest(budget - used, 0))
          OVER ({order} UNBOUNDED PRECEDING AND CURRENT ROW) AND weight > 0 AS "full" FROM r{level}),
        s{level} AS (SELECT *, greatest(budget - coalesce(sum(CASE WHEN "full" THEN capacity END) OVER ({by}), 0), 0)::HUGEINT AS rest,
          coalesce(sum(CASE WHEN NOT "full" THEN weight END) OVER ({order} UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS low,
          coalesce(sum(CASE WHEN NOT "full" THEN weight END) OVER ({order} UNBOUNDED PRECEDING AND CURRENT ROW), 0)::HUGEINT AS high,
          sum(CASE WHEN NOT "full" THEN weight END) OVER ({by})::HUGEINT AS everything FROM f{level}),
        b{level} AS (SELECT {keys}, CASE WHEN "full" THEN capacity
          ELSE coalesce(rest * high // greatest(everything, 1) - rest * low // greatest(everything, 1), 0) END::HUGEINT AS budget FROM s{level})""")
        parent = f"b{level}"
    parts.append(f"""e AS (SELECT d.*, budget, CASE WHEN available > 0 THEN budget // available ELSE 0 END AS epochs, available
        FROM d JOIN {parent} USING (domain, language, origin) JOIN leaf USING (domain, language, origin)),
        o AS (SELECT *, budget - epochs * available AS rest, sha256(concat_ws(':', '{seed}', epochs::VARCHAR, doc_id::VARCHAR)) AS place FROM e),
        u AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, language, origin ORDER BY place, doc_id, n_tokens
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::HUGEINT AS upto FROM o),
        t AS (SELECT *, least(n_tokens, greatest(0, rest - (upto - n_tokens))) AS taken FROM u)""")
    return f"""WITH {", ".join(parts)}
    SELECT doc_id, domain, language, origin, n_tokens::BIGINT AS n_tokens, budget::BIGINT AS leaf_budget, epochs::BIGINT AS epochs,
    taken::BIGINT AS taken, epochs > 0 OR taken > 0 AS selected FROM t"""
