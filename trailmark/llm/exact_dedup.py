"""Exact dedup by deterministic block naming, in DataFrame functions only.

A text is cut into blocks of BLOCK bytes. Equal blocks get one integer name: the distinct blocks are sorted within
their hash partition and numbered (partition number, then rank). Adjacent pairs of names are then named the same way,
level by level, until each document has a single name. Two documents are equal when both the number of blocks and the
last name agree; a name never stands for two different contents, so no collision is possible.

Only the distinct blocks themselves are shuffled. The rows of the documents carry a 128-bit key of each block instead
of its bytes, and the key is used only after it was shown, over all distinct blocks at hand, to be different for
different blocks; if it were not, the next key is tried. That keeps the result exact at the cost of one shuffle of the
text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm.common import SPACE_RUN, row_key, table, written

#: Bytes of a block.
BLOCK = 4096


def normalised(text: Column) -> Column:
    """Runs of white space become one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def _blocks(text: Column, size: int) -> Column:
    """The text's bytes in blocks of `size`; the empty text has one empty block."""
    raw = text.cast("binary")
    last = F.greatest(F.ceil(F.octet_length(text) / size), F.lit(1)).cast("int") - 1
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(raw, i * size + 1, F.lit(size)))


def _key(block: Column, attempt: int, bits: int) -> Column:
    """A 128-bit key of a block; fewer bits only in tests, where keys are to collide. Each attempt has another key."""
    first = F.xxhash64(F.lit(2 * attempt), block)
    second = F.xxhash64(F.lit(2 * attempt + 1), block)
    if bits < 64:
        cut = F.lit((1 << min(63, bits * (attempt + 1))) - 1)
        first, second = first.bitwiseAND(cut), second.bitwiseAND(cut)
    return F.struct(first.alias("a"), second.alias("b"))


def _numbered(distinct: DataFrame, by: list[str]) -> DataFrame:
    """Adds an integer name to distinct rows: they are sorted within their partition and numbered in that order."""
    return distinct.sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id())


def identities(texts: DataFrame, block: int = BLOCK, bits: int = 64) -> DataFrame:
    """(n_blocks, name, and the other columns) of rows with a column `norm`; `norm` is replaced by text_sha256.

    Rows with equal `norm`, and no others, have the same (n_blocks, name).
    """
    others = [c for c in texts.columns if c != "norm"]
    cut = texts.select(F.explode(_blocks(F.col("norm"), block)).alias("block"))
    attempt = 0
    while True:
        names = written(
            _numbered(cut.select("block").distinct(), ["block"]).select(
                _key(F.col("block"), attempt, bits).alias("key"), "name"
            ),
            "block-names",
        )
        if names.groupBy("key").count().where("count > 1").isEmpty():
            break
        attempt += 1
    keyed = texts.select(
        F.struct(*others).alias("row"),
        F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
        F.transform(_blocks(F.col("norm"), block), lambda b: _key(b, attempt, bits)).alias("keys"),
    ).withColumn("id", F.monotonically_increasing_id())
    rows = written(keyed, "block-keys")
    # level 0: the key of each block becomes its name
    done: list[DataFrame] = []
    placed = rows.select("id", F.posexplode("keys").alias("pos", "key")).join(names, "key").select("id", "pos", "name")
    most = rows.agg(F.max(F.size("keys"))).first()[0] or 0
    size = rows.select("id", F.size("keys").alias("n_left"))
    level = written(placed.join(size, "id"), "names")
    while True:
        done.append(level.where("n_left = 1").select("id", "name"))
        if most <= 1:
            break
        # name adjacent pairs; the last of an odd number is paired with nothing
        pairs = level.where("n_left > 1").groupBy("id", "n_left", F.floor(F.col("pos") / 2).alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("l"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("r"),
        )
        pairs = written(pairs.withColumn("n_left", F.ceil(F.col("n_left") / 2).cast("int")), "pairs")
        named = _numbered(pairs.select("l", "r").distinct(), ["l", "r"])
        level = written(pairs.join(named, ["l", "r"]).select("id", "pos", "name", "n_left"), "names")
        most = (most + 1) // 2
    last = done[0]
    for more in done[1:]:
        last = last.unionByName(more)
    return rows.join(last, "id").select(
        "id", "row.*", "text_sha256", F.size("keys").alias("n_blocks"), "name"
    )


def _judged(rows: DataFrame, block: int, bits: int) -> DataFrame:
    """rows (doc_id, tie, norm) with keep_id, group_size, kept and text_sha256 for norm; of rows with the least doc_id
    the one with the least tie is kept."""
    named = written(identities(rows, block, bits), "identities")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie", "id")
    best = named.groupBy("n_blocks", "name").agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("group_size"))
    return named.join(best, ["n_blocks", "name"]).select(
        "doc_id",
        "tie",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("id") == F.col("best.id")).alias("kept"),
        "text_sha256",
    )


def exact_dedup(docs: DataFrame, block: int = BLOCK, bits: int = 64) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty and are equal to texts that are empty after normalisation. Of equal texts the row with
    the smallest doc_id stays (null ids last); of repeated rows with that id exactly one stays. Other columns of docs
    are ignored, whatever their names. An empty table gives no rows.
    """
    rows = docs.select("doc_id", F.lit("").alias("tie"), normalised(F.col("text")).alias("norm"))
    return _judged(rows, block, bits).drop("tie")


def keep_first(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row of docs for each different text, with docs' own columns: that with the smallest doc_id (null ids last).
    Of rows with that id and text, which may differ in other columns or in white space, the one with the least row key
    stays, so a rerun keeps the same. Null and empty texts are equal; an empty table gives no rows."""
    rows = docs.select("doc_id", row_key(docs).alias("tie"), normalised(F.col("text")).alias("norm"))
    stay = _judged(rows, block, 64).where("kept").select(F.col("tie").alias("__key"))
    # only rows repeated as a whole share a key
    marked = docs.withColumn("__key", row_key(docs))
    return marked.join(stay, "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")


QUERY = "op5_exact_dedup"

ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))
