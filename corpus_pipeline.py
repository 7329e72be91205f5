"""From raw documents to token ids: one pipeline of five stages over whole tables.

Each stage takes (spark, docs, folder), works on all that the one before kept,
and returns a frame that is written as Parquet and read again. All but the
last return the columns of the documents.
"""

import public_tokenizers

from tidegrid.llm import bpe, exact, langid, mixing, simhash
from tidegrid.llm.support import bound_batches
from tidegrid.session import store


def known_language(spark, docs, folder):
    """Documents without letters go, and those of which no language gets three tenths of the chances."""
    bound_batches(spark)
    return langid.keep_known(docs, least=0.3)


def distinct_texts(spark, docs, folder):
    """Of equal texts the document with the largest identifier stays.

    Null and empty texts are equal, rows without identifier are no copies of
    others while one with an identifier stays, and an empty table gives none.
    """
    bound_batches(spark)
    return exact.dedup(docs, keep="largest")


def distinct_enough(spark, docs, folder):
    """Of near copies the document with the smallest identifier stays.

    Near copies are those that SimHash links: fingerprints of shingles of
    three words that differ in at most three bits, and chains of such links.
    Texts without words share one fingerprint. A null text counts as empty,
    rows without identifier stay, and an empty table gives none.
    """
    bound_batches(spark)
    return simhash.dedup(docs, words=3, distance=3)


def mixture(spark, docs, folder):
    """Documents that fill the target weights within four fifths of all tokens."""
    keys, weights = mixing.production()
    return mixing.keep_selected(docs, keys, weights, fraction=(4, 5), epochs=1, seed=17)


def tokens(spark, docs, folder):
    """Token ids of each document, and digests of them and of what they decode to."""
    bound_batches(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN, ids=True)


STAGES = [
    ("language", known_language),
    ("exact", distinct_texts),
    ("near", distinct_enough),
    ("mixture", mixture),
    ("tokens", tokens),
]

# The language stage rests on a trained network, which SQL cannot express.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
