"""Mixing of sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a shuffled order (by a hash of doc_id), played up to MAX_REPEATS times; a
time that a document is played is a turn. A turn's virtual finish time is the words its source has sent by its end,
divided by the source's target. The turns of all sources are put in order of that time over ranges of it, with a
running total of their words, and the mix is cut where the total reaches the budget. In that order the queues advance
in proportion to their targets, so at the cut every source has sent about its target.

A turn during which its source reaches its target is two packets in that order, the words up to the target and the
rest, so that a very long document neither keeps a small source from its target nor carries it far beyond. The digest
of the query counts the words before the cut; `mix` takes the documents of which words are before it whole.

Running totals are sums over buckets (of the shuffled order within a source, then of virtual time) and sums within a
bucket, so that a source with any share of the rows is spread over many tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trailmark.llm.common import row_key, table, words, written

#: Weights of the sources in code point order, repeating; budget as a ratio of all words; how often a document may be
#: taken.
WEIGHTS = (3, 1, 2)
BUDGET = (3, 2)
MAX_REPEATS = 2
#: About so many rows share a bucket, or the square root of all rows if that is more: then neither the rows of a bucket
#: nor the buckets, whose sums one task puts in order, grow faster than that.
BUCKET_ROWS = 1_000


def _sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, shuffle, row_key) for each row: the words of the text and the place in the shuffled order."""
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.size(words(F.col("text"))).cast("bigint").alias("size"),
        F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).cast("binary")).alias(
            "shuffle"
        ),
        row_key(docs).alias("row_key"),
    )


def targets(sources: DataFrame, weights=WEIGHTS, budget=BUDGET, repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, rows, target) from (source, source_size, rows).

    The budget is shared by weight; no target is above `repeats` times its source's size, and what is over is shared
    again by weight. Solved in one pass: sources are filled in the order of size / weight, and a source is at its
    limit exactly when the share it would get from what the smaller ones leave reaches that limit. The table has one
    row for each source.
    """
    cycle = F.array(*[F.lit(w) for w in weights])
    place = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    s = sources.withColumn(
        "weight", F.get(cycle, (F.row_number().over(place) - 1) % len(weights)).cast("bigint")
    ).withColumn("limit", F.col("source_size") * repeats)
    fill = Window.partitionBy(F.lit(0)).orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    num, den = budget
    s = s.withColumns(
        {
            # den times what is left for this source and the later ones, and their weights
            "left": F.sum("source_size").over(everything) * num - F.coalesce(F.sum("limit").over(before), F.lit(0)) * den,
            "of": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    ).withColumn("full", F.col("left") * F.col("weight") >= F.col("limit") * F.col("of") * den)
    # those not at their limit share what the full ones leave
    s = s.withColumns(
        {
            "rest": F.sum("source_size").over(everything) * num
            - F.coalesce(F.sum(F.when(F.col("full"), F.col("limit"))).over(everything), F.lit(0)) * den,
            "open": F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything),
        }
    )
    share = (F.col("weight") * F.col("rest")).cast("double") / (F.col("open") * den).cast("double")
    return s.select(
        "source",
        "source_size",
        "rows",
        F.when(F.col("full"), F.col("limit").cast("double")).otherwise(share).alias("target"),
    )


def _bucket_rows(rows: int) -> int:
    return max(BUCKET_ROWS, math.isqrt(rows))


def _positions(sized: DataFrame, by_source: DataFrame, bucket_rows: int) -> DataFrame:
    """Adds `start`, the words of the source before the document in the shuffled order, and the source's figures."""
    named = by_source.select(F.col("source").alias("__s"), "source_size", "target", "rows")
    rows = sized.join(named, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    # the leading 48 bits of the shuffle, as a share of the source's buckets
    part = F.conv(F.substring("shuffle", 1, 12), 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 48))
    rows = rows.withColumn("bucket", F.floor(part * F.ceil(F.col("rows") / bucket_rows)).cast("bigint"))
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
    line = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("source").alias("__s"), F.col("bucket").alias("__b"),
        F.coalesce(F.sum("in_bucket").over(line), F.lit(0)).alias("before"),
    )
    inside = (
        Window.partitionBy("source", "bucket")
        .orderBy("shuffle", "doc_id", "size", "row_key")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = rows.withColumns(
        {
            "within": F.coalesce(F.sum("size").over(inside), F.lit(0)),
            "seq": F.row_number().over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        }
    )
    joined = rows.join(sums, F.col("source").eqNullSafe(F.col("__s")) & (F.col("bucket") == F.col("__b")))
    return joined.withColumn("start", F.col("before") + F.col("within")).drop("__s", "__b", "before", "within")


def placed(docs: DataFrame, repeats: int = MAX_REPEATS, budget=BUDGET) -> tuple[DataFrame, int, int]:
    """(rows, their number, the budget in words): each row of docs with its place: doc_id, row_key, source, size,
    source_size, target, start, bucket and seq (which tell rows apart).

    Null sources are one source, the last in order; null texts have no words. Rows with equal ids are told apart by
    all their columns.
    """
    sized = written(_sizes(docs), "sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    all_ = sources.agg(F.sum("source_size").alias("words"), F.sum("rows").alias("rows")).first()
    n = all_["rows"] or 0
    rows = _positions(sized, targets(sources, budget=budget, repeats=repeats), _bucket_rows(n))
    return rows, n, (all_["words"] or 0) * budget[0] // budget[1]


def packets(rows: DataFrame, repeats: int = MAX_REPEATS) -> DataFrame:
    """The packets of every turn that begins before virtual time 2, with the columns of rows, turn, packet (0 or 1),
    begin, n_words and the virtual finish time. The cut comes about virtual time 1, as the targets add up to the budget
    and what is left over of it is under one word for each source. Documents without words have none."""
    begin = F.col("start") + F.col("turn") * F.col("source_size")
    upto = F.greatest(F.least(F.floor("target") - F.col("begin"), F.col("size")), F.lit(0)).cast("bigint")
    both = F.array(
        F.struct(F.lit(0).alias("packet"), F.col("begin"), upto.alias("n_words")),
        F.struct(F.lit(1).alias("packet"), (F.col("begin") + upto).alias("begin"), (F.col("size") - upto).alias("n_words")),
    )
    played = rows.withColumn("turn", F.explode(F.array(*[F.lit(k) for k in range(repeats)]))).withColumn("begin", begin)
    played = played.where((F.col("size") > 0) & (F.col("begin") < 2 * F.col("target")))
    each = played.withColumn("x", F.explode(both)).drop("begin").select("*", "x.*").drop("x").where("n_words > 0")
    return each.withColumn("finish", (F.col("begin") + F.col("n_words")).cast("double") / F.col("target"))


def cut(sent: DataFrame, rows: int, budget: int) -> DataFrame:
    """packets with `taken`, their words before the cut: all packets in order of virtual finish time (ties by source,
    turn and place), added up, end at the budget."""
    ranges = max(1, math.ceil(rows / _bucket_rows(rows)))
    sent = sent.withColumn("range_no", F.floor(F.least("finish", F.lit(2.0)) * F.lit(ranges)).cast("bigint"))
    sums = sent.groupBy("range_no").agg(F.sum("n_words").alias("in_range"))
    line = Window.partitionBy(F.lit(0)).orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("range_no", F.coalesce(F.sum("in_range").over(line), F.lit(0)).alias("ahead"))
    inside = (
        Window.partitionBy("range_no")
        .orderBy("finish", F.col("source").asc_nulls_last(), "turn", "packet", "bucket", "seq")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    sent = sent.withColumn("within", F.coalesce(F.sum("n_words").over(inside), F.lit(0))).join(sums, "range_no")
    left = F.lit(budget).cast("bigint") - F.col("ahead") - F.col("within")
    taken = F.greatest(F.least(F.col("n_words"), left), F.lit(0).cast("bigint"))
    return sent.withColumn("taken", taken).drop("range_no", "ahead", "within")


def schedule(docs: DataFrame, repeats: int = MAX_REPEATS, budget=BUDGET) -> DataFrame:
    """The mix in order of virtual finish time: (row_key, doc_id, source, turn, finish, n_words, taken) for each time a
    document is in it, with all its words and those before the cut. Of documents without words those that come before
    their source's target are in it, once."""
    rows, n, words_ = placed(docs, repeats, budget)
    found = cut(packets(rows, repeats), n, words_).where("taken > 0 AND begin < target")
    keys = ["source", "bucket", "seq", "turn", "doc_id", "row_key"]
    played = found.groupBy(*keys).agg(
        F.max("finish").alias("finish"), F.max("size").alias("n_words"), F.sum("taken").alias("taken")
    )
    empty = rows.where("size = 0 AND start <= target").select(
        "source", "bucket", "seq", F.lit(0).alias("turn"), "doc_id", "row_key",
        F.when(F.col("target") > 0, F.col("start") / F.col("target")).otherwise(F.lit(0.0)).alias("finish"),
        F.col("size").alias("n_words"), F.col("size").alias("taken"),
    )
    return played.unionByName(empty).orderBy("finish", F.col("source").asc_nulls_last(), "turn", "bucket", "seq")


def mix(docs: DataFrame) -> DataFrame:
    """docs in the mix: a row for each time a document is played, in order of virtual finish time, with docs' own
    columns and whole texts. A source passes its target by less than one document. Null sources and texts as in
    `placed`; rows repeated as a whole are played each for itself; an empty table gives no rows."""
    plan = schedule(docs).select(F.col("row_key").alias("__key"), *[F.col(c).alias(f"__{c}") for c in ("finish", "turn")])
    # rows repeated as a whole share a key, and only they do
    once = docs.withColumn("__key", row_key(docs)).dropDuplicates(["__key"])
    return once.join(plan, "__key").orderBy("__finish", "__key", "__turn").select(*[f"`{c}`" for c in docs.columns])


QUERY = "op1_mixing"

ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix:' || CAST(doc_id AS VARCHAR)) AS shuffle
  FROM documents
), by_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source
), filling AS (
  SELECT *, 3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) OVER before, 0) AS left_over,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS of_weight
  FROM by_source
  WINDOW before AS (ORDER BY source_size / CAST(weight AS DOUBLE), source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), filled AS (SELECT *, left_over * weight >= 4 * source_size * of_weight AS is_full FROM filling),
goal AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN CAST(2 * source_size AS DOUBLE)
              ELSE CAST(weight * (3 * sum(source_size) OVER ()
                        - 4 * coalesce(sum(CASE WHEN is_full THEN source_size END) OVER (), 0)) AS DOUBLE)
                   / CAST(2 * sum(CASE WHEN NOT is_full THEN weight END) OVER () AS DOUBLE) END AS target
  FROM filled
), placed AS (
  SELECT s.doc_id, s.source, s.shuffle, s.size, g.source_size, g.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.shuffle, s.doc_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source
), turns AS (
  SELECT *, start + turn * source_size AS turn_begin,
         greatest(least(floor(target) - (start + turn * source_size), size), 0) AS upto
  FROM placed, (SELECT unnest([0, 1]) AS turn) WHERE size > 0
), packets AS (
  SELECT *, turn_begin AS begin, upto AS n_words, 0 AS packet FROM turns WHERE upto > 0
  UNION ALL
  SELECT *, turn_begin + upto, size - upto, 1 FROM turns WHERE size > upto
), sent AS (
  SELECT doc_id, n_words,
         coalesce(sum(n_words) OVER (ORDER BY CAST(begin + n_words AS DOUBLE) / target, source NULLS LAST, turn, packet,
                                              shuffle, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM packets
), taken AS (
  SELECT doc_id, sum(greatest(least(n_words, (SELECT sum(size) * 3 // 2 FROM sized) - ahead), 0)) AS taken
  FROM sent GROUP BY doc_id
)
SELECT p.doc_id, CAST(p.size AS BIGINT) AS size, p.source_size, p.target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken
FROM placed p LEFT JOIN taken t ON p.doc_id IS NOT DISTINCT FROM t.doc_id
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of the cut: one row per document, the words of all its packets before it added up."""
    rows, n, words_ = placed(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    rows = written(rows.drop("shuffle", "row_key"), "placed")
    taken = cut(packets(rows), n, words_).where("taken > 0")
    keys = ["source", "bucket", "seq"]
    taken = taken.groupBy(*keys).agg(F.sum("taken").alias("taken")).withColumnsRenamed({k: f"__{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return rows.join(taken, same, "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken")
    )
