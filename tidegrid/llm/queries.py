"""The registered queries of this subpackage, over whole tables, and their SQL twins."""

import public_tokenizers
from pyspark.sql import functions as F

from tidegrid.llm import ann, bpe, codes, divergence, exact, langid, mixing, pii, simhash, spans, suffix, toxicity, warc
from tidegrid.llm.support import bound_batches
from tidegrid.session import scratch_path

QUERIES = {}
ORACLES = {}


def query(sql=None):
    """Register a `(spark, folder) -> DataFrame` under its own name."""

    def add(function):
        def run(spark, folder):
            bound_batches(spark)
            return function(spark, folder)

        QUERIES[function.__name__] = run
        if sql:
            ORACLES[function.__name__] = sql
        return run

    return add


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op1_byte_bpe(spark, folder):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


# DuckDB lower-cases more than A-Z, so the twin names the 26 letters.
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    f"""
    WITH d AS (SELECT doc_id, {_LOWERED} AS body FROM documents),
    g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
    FROM d JOIN g USING (body)
    """
)
def op2_exact_dedup(spark, folder):
    return exact.groups(table(spark, folder, "documents"), keep="largest")


@query()
def op8_simhash(spark, folder):
    return simhash.groups(table(spark, folder, "documents"), words=3, lanes=1, segment=32, distance=3)


@query()
def op9_language(spark, folder):
    return langid.identify(table(spark, folder, "documents"), per_language=300, steps=160)


_MIX = mixing.production_sql()


@query(_MIX)
def op3_mixing(spark, folder):
    keys, weights = mixing.production()
    mixed = mixing.mix(table(spark, folder, "documents"), keys, weights, fraction=(3, 4), epochs=2, seed=17)
    return mixed.select("doc_id", "domain", "language", "origin", "n_tokens", "leaf_budget", "epochs", "taken", "selected")


@query()
def op4_sentence_spans(spark, folder):
    return spans.remove_repeats(table(spark, folder, "documents"), run=3, words=10, digest=True)


@query()
def op5_personal_data(spark, folder):
    found = pii.detect(table(spark, folder, "documents"), documents=2000, forms=600)
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


@query()
def op6_toxicity(spark, folder):
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return toxicity.score(documents, toxicity.train(documents, labels, most_toxic=1500, most_ordinary=4000))


@query()
def op7_nearest(spark, folder):
    return ann.search(table(spark, folder, "embeddings"), lambda id: id % 20 == 0, k=20)


@query()
def op10_suffix_array(spark, folder):
    return suffix.remove_repeats(table(spark, folder, "documents"), length=50, digest=True)


@query(
    """
    WITH d AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
    f AS (SELECT digest, min(page_id) AS least FROM d WHERE n >= 100 GROUP BY digest)
    SELECT page_id, n AS payload_bytes, digest AS payload_digest,
      CASE WHEN page_id > least THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN page_id > least THEN least END AS refers_to
    FROM d LEFT JOIN f USING (digest)
    """
)
def op11_warc(spark, folder):
    return warc.round_trip(table(spark, folder, "pages"), scratch_path(spark, "archives"))


def _codes_sql():
    """Two rounds and a last assignment: what `codes` computes, with all distances written out."""
    near = lambda books: f"""SELECT vec_id, label, p, a, b, c, d, min(((a - ea) * (a - ea) + (b - eb) * (b - eb) + (c - ec) * (c - ec) + (d - ed) * (d - ed)) * 64 + e) AS m
      FROM x JOIN {books} USING (p) GROUP BY ALL"""
    floor = lambda v: f"(CASE WHEN n IS NULL THEN e{v} ELSE (s{v} - ((s{v} % n) + n) % n) // n END)::BIGINT AS e{v}"
    move = lambda books, held: f"""SELECT p, e, {", ".join(floor(v) for v in "abcd")} FROM {books} LEFT JOIN
      (SELECT p, m % 64 AS e, count(*) AS n, sum(a) AS sa, sum(b) AS sb, sum(c) AS sc, sum(d) AS sd FROM {held} GROUP BY ALL) USING (p, e)"""
    return f"""
    WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    x AS (SELECT vec_id, label, p, v[4 * p + 1] AS a, v[4 * p + 2] AS b, v[4 * p + 3] AS c, v[4 * p + 4] AS d FROM k, (SELECT unnest(range(16)) AS p)),
    s AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k QUALIFY e < 64),
    c0 AS (SELECT p, e, a AS ea, b AS eb, c AS ec, d AS ed FROM x JOIN s USING (vec_id)),
    n0 AS ({near("c0")}), c1 AS ({move("c0", "n0")}), n1 AS ({near("c1")}), c2 AS ({move("c1", "n1")}), n2 AS ({near("c2")}),
    r AS (SELECT vec_id, label, string_agg(printf('%02x', m % 64), '' ORDER BY p) AS code, sum(m // 64)::BIGINT AS error FROM n2 GROUP BY ALL),
    h AS (SELECT sha256(string_agg(ea || ',' || eb || ',' || ec || ',' || ed, ',' ORDER BY p, e)) AS codebooks_sha256 FROM c2)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM r, h
    """


@query(_codes_sql())
def op12_vector_codes(spark, folder):
    coded = codes.compress(table(spark, folder, "embeddings"), parts=16, entries=64, rounds=2)
    return coded.rows.withColumnRenamed("id", "vec_id").withColumn("codebooks_sha256", F.lit(codes.digest(coded.codebooks)))


@query(
    """
    WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
    t AS MATERIALIZED (SELECT r, lang, source, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
    c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
    g AS (SELECT lang, source FROM d GROUP BY ALL),
    f AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN k ON g.lang = k.lang
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
    p AS (SELECT lang, source, term, f.n, 1 + (1000000000::HUGEINT * (f.n + 5)) // (sum(f.n) OVER (PARTITION BY lang, source) + 5 * v) AS p FROM f JOIN v USING (lang)),
    w AS (SELECT lang, term, sum(n) AS n FROM f GROUP BY ALL),
    q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (w.n + 5)) // (sum(w.n) OVER (PARTITION BY lang) + 5 * v) AS q FROM w JOIN v USING (lang)),
    pairs AS (SELECT a.lang, a.source, b.source AS item FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
    sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    r AS (SELECT lang, source, 'pair' AS part, item, coalesce(value, 0)::BIGINT AS value FROM pairs LEFT JOIN sums USING (lang, source, item)
      UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM r QUALIFY part = 'pair' OR rank <= 50
    """
)
def op13_divergence(spark, folder):
    return divergence.audit(table(spark, folder, "documents"), least=30, top=50)
