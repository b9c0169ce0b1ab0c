"""The stages of the corpus pipeline: toxic documents go, then exact and near copies; the rest is mixed and tokenised.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. `run` writes each stage's
result to the shared folder and reads it again, as the stages are meant to be run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm import byte_bpe, exact_dedup, jaccard_dedup, mixing, simhash_dedup, toxicity
from trailmark.llm.common import table, written

#: Some stages have no equal in SQL (the toxicity model, near copies, BPE merges).
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of docs that the severity model, fitted on the labelled documents, does not call toxic, with docs' own
    columns. A null, empty or wordless text is clean; repeated rows are judged one by one; an empty table, or labels of
    one kind only, drop nothing."""
    return toxicity.clean(docs, toxicity.trained(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for their white space, the row with the smallest doc_id, with docs' own columns.
    Null and empty texts are equal; a null id counts as the greatest; of rows with one id the one with the least row
    key stays, so of repeated rows one; an empty table gives no rows."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies: that with the smallest doc_id, with docs' own columns. Candidates are the
    components of op7's SimHash fingerprints, whose covering tables miss no pair within their few bits, and, for pairs
    beyond those bits, MinHash bands; an exact check follows: five-word shingles, Jaccard similarity 0.8 or more.
    Wordless texts, null ones included, are one component; null ids, rows with one id, repeated rows and empty tables as
    in `drop_copies`."""
    return jaccard_dedup.keep_one(docs, near=simhash_dedup.text_roots(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources to their target weights: a row of docs, whole, for each time it is taken. Null sources are
    one source, the last; a wordless text is taken at most once; rows with one id, and repeated rows, are taken each
    for itself; an empty table gives no rows."""
    return mixing.mix(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids): the mix in byte-level BPE ids, for every row of it, repeated ones included. A null or
    empty text has no ids; an empty table gives no rows."""
    tokens = byte_bpe.encode(docs, *byte_bpe.default_vocabulary())
    return tokens.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte-level BPE", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, "stage-" + name.replace(" ", "-"))
    return docs
