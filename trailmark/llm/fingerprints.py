"""Document fingerprints by SimHash, in DataFrame functions only.

Terms are pairs of neighbouring words (one word alone where a text has no second). A term's hash votes with its weight
on the signed bits of a 128-bit fingerprint; longer pairs, which are rarer, weigh more, and a term votes once for each
time it occurs. `within_radius` finds all fingerprints within a Hamming radius of those of a query set by permuted
block tables: the bits are cut into blocks, and by the pigeonhole principle a pair within the radius agrees on some
choice of blocks, each choice being a table that is joined on those bits.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trailmark.llm import votes
from trailmark.llm.common import ascii_lower, table, words, written

#: Rows of a range of doc_id that one task puts in order; the number of ranges follows the table's size.
RANGE_ROWS = 2_000
#: At most so many ranges, as their bounds are a literal of the plan: beyond 20 million documents the ranges get longer
#: (10^10 documents: a million each) and are sorted with spill, with the same result.
MAX_RANGES = 10_000
_LEAST = -(1 << 63)


def _weight(first: Column, second: Column) -> Column:
    length = F.char_length(first) + F.coalesce(F.char_length(second), F.lit(0))
    return F.least(F.greatest(length - 4, F.lit(1)), F.lit(16)).cast("bigint")


def with_fingerprints(rows: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """One row per different `keys`: the keys, and the fingerprint's words fp_a, fp_b. Rows with equal keys must have
    equal texts (their votes only multiply). Null and blank texts have the fingerprint zero."""
    cut = rows.select(*keys, words(ascii_lower(F.col(text))).alias("__w"))
    at = votes.exploded(cut, "__w", 2)
    first, second = F.get("__w", F.col("i")), F.get("__w", F.col("i") + 1)
    hashed = at.select(
        *keys,
        F.when(F.col("i").isNotNull(), F.xxhash64(first, second)).alias("__h"),
        F.when(F.col("i").isNotNull(), _weight(first, second)).alias("__n"),
    ).withColumn("__g", F.when(F.col("__h").isNotNull(), F.xxhash64("__h")))
    sums = hashed.groupBy(*keys).agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("__total"),
        *votes.lane_sums(F.col("__h"), F.col("__n"), "a"),
        *votes.lane_sums(F.col("__g"), F.col("__n"), "b"),
    )
    return sums.select(
        *keys,
        votes.majority("a", F.col("__total")).alias("fp_a"),
        votes.majority("b", F.col("__total")).alias("fp_b"),
    )


def distance(a: tuple[str, str], b: tuple[str, str]) -> Column:
    """Differing bits of two fingerprints, each the names of its two words."""
    return F.bit_count(F.col(a[0]).bitwiseXOR(F.col(b[0]))) + F.bit_count(F.col(a[1]).bitwiseXOR(F.col(b[1])))


def likeness(bits: Column) -> Column:
    """The cosine that so many differing bits of 128 stand for, 0 at least: 1 for equal fingerprints, 0 from 64 bits."""
    return F.when(bits >= 64, F.lit(0.0)).otherwise(F.cos(bits * F.lit(math.pi / 128)))


def _near_pairs(queries: DataFrame, rows: DataFrame, radius: int, blocks: int) -> DataFrame:
    """(fp_a, fp_b, ra, rb, bits) of the different fingerprints of queries and of rows with at most `radius` differing
    bits, by the permuted block tables."""
    if not 0 <= radius < blocks or 128 % blocks:
        raise ValueError("radius must be below blocks, and blocks divide 128")
    width = 128 // blocks
    tables = []
    for chosen in combinations(range(blocks), blocks - radius):
        mask = [0, 0]
        for b in chosen:
            for bit in range(b * width, (b + 1) * width):
                mask[bit // 64] |= 1 << (bit % 64)
        tables.append([m - (1 << 64) if m >> 63 else m for m in mask])

    def placed(df: DataFrame) -> DataFrame:
        keys = [
            F.struct(
                F.lit(k).alias("t"),
                F.col("fp_a").bitwiseAND(F.lit(a)).alias("ka"),
                F.col("fp_b").bitwiseAND(F.lit(b)).alias("kb"),
            )
            for k, (a, b) in enumerate(tables)
        ]
        return df.select("fp_a", "fp_b", F.explode(F.array(*keys)).alias("x")).select("fp_a", "fp_b", "x.*")

    q = placed(queries.select("fp_a", "fp_b").distinct())
    r = placed(rows.select("fp_a", "fp_b").distinct()).withColumnsRenamed({"fp_a": "ra", "fp_b": "rb"})
    bits = distance(("fp_a", "fp_b"), ("ra", "rb"))
    pairs = q.join(r, ["t", "ka", "kb"]).withColumn("bits", bits).where(F.col("bits") <= radius)
    return pairs.select("fp_a", "fp_b", "ra", "rb", "bits").distinct()


def within_radius(queries: DataFrame, rows: DataFrame, radius: int = 3, blocks: int = 8) -> DataFrame:
    """All (query_id, row_id, bits) with at most `radius` differing bits; a row does not find itself.

    queries and rows: id, fp_a, fp_b. Equal fingerprints of `rows` are made one before the tables are joined and
    spread out only for the result. Needs radius < blocks; each of the C(blocks, radius) tables agrees on
    blocks - radius blocks, so a chance agreement costs 2^-(128 (blocks - radius) / blocks). Rows without an id are
    not found; empty tables give no rows.
    """
    pairs = _near_pairs(queries, rows, radius, blocks)
    named = queries.select(F.col("id").alias("query_id"), "fp_a", "fp_b").join(pairs, ["fp_a", "fp_b"])
    other = rows.select(F.col("id").alias("row_id"), F.col("fp_a").alias("ra"), F.col("fp_b").alias("rb"))
    return named.join(other, ["ra", "rb"]).where("query_id <> row_id").select("query_id", "row_id", "bits")


def neighbour_counts(queries: DataFrame, rows: DataFrame, radius: int = 3, blocks: int = 4) -> DataFrame:
    """(fp_a, fp_b, neighbours) for each different fingerprint of queries (fp_a, fp_b): how many rows (fp_a, fp_b) are
    within `radius` bits of it, equal ones included. Rows with one fingerprint are counted first and never spread out,
    so copies cost nothing; arguments as in `within_radius`. With four blocks there are four tables of 32 bits."""
    counted = rows.groupBy("fp_a", "fp_b").agg(F.count(F.lit(1)).alias("n"))
    pairs = _near_pairs(queries, counted, radius, blocks)
    sizes = counted.withColumnsRenamed({"fp_a": "ra", "fp_b": "rb"})
    return pairs.join(sizes, ["ra", "rb"]).groupBy("fp_a", "fp_b").agg(F.sum("n").alias("neighbours"))


def _longs(values: list[int]) -> Column:
    """A literal array of longs."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _bounds(docs: DataFrame) -> list[int]:
    """Descending lower bounds that cut doc_id into ranges of about RANGE_ROWS rows; they only balance the work."""
    parts = min(MAX_RANGES, math.ceil((docs.agg(F.count("doc_id")).first()[0] or 0) / RANGE_ROWS))
    if parts <= 1:
        return []
    at = docs.agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)], 10 * parts)).first()[0]
    return sorted(set(at), reverse=True)


def _range_of(doc_id: Column, bounds: list[int]) -> Column:
    """How many bounds are above doc_id, found in two steps of about the square root of their number."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    tops, whole = _longs(bounds[::step]), _longs(bounds)
    passed = F.greatest(F.size(F.filter(tops, lambda b: b > doc_id)) - 1, F.lit(0)) * step
    return passed + F.size(F.filter(F.slice(whole, passed + 1, F.lit(step)), lambda b: b > doc_id))


def in_order(docs: DataFrame) -> DataFrame:
    """Each document beside the one that follows it in descending order of doc_id (the first after the last).

    Columns: range_no, seq (the place within the range), guest, doc_id, text, next_id, next_text. Rows with a null
    doc_id come last, ties go by a hash of the text. One task puts one range of ids in order; the first document of a
    range is added to the range before it as a guest, so no global sort and no second shuffle is needed. Guests are
    left in for callers that look at the next row once more.
    """
    bounds = _bounds(docs)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    place = F.coalesce("doc_id", F.lit(_LEAST))
    rows = rows.withColumn("range_no", _range_of(place, bounds))
    order = F.struct(place.alias("d"), F.xxhash64("text").alias("h"))
    found = rows.groupBy("range_no").agg(F.max(order).alias("o")).collect()  # one row for each range
    firsts = {r["range_no"]: (r["o"]["d"], r["o"]["h"]) for r in found}
    own = F.struct(F.col("range_no").alias("r"), F.lit(False).alias("g"))
    places = F.array(own)
    if firsts:
        used, top = sorted(firsts), max(firsts)
        before = {r: used[k - 1] for k, r in enumerate(used)}  # the first range's guest goes to the last range
        ids = _longs([firsts.get(r, (0, 0))[0] for r in range(top + 1)])
        hashes = _longs([firsts.get(r, (0, 0))[1] for r in range(top + 1)])
        homes = _longs([before.get(r, 0) for r in range(top + 1)])
        opens = (F.get(ids, F.col("range_no")) == place) & (F.get(hashes, F.col("range_no")) == F.xxhash64("text"))
        there = F.struct(F.get(homes, F.col("range_no")).cast("int").alias("r"), F.lit(True).alias("g"))
        places = F.when(opens, F.array(own, there)).otherwise(places)
    dealt = rows.select("doc_id", "text", F.explode(places).alias("x")).select(
        F.col("x.r").alias("range_no"), F.col("x.g").alias("guest"), "doc_id", "text"
    )
    line = Window.partitionBy("range_no").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text").desc())
    return dealt.select(
        "*",
        F.row_number().over(line).alias("seq"),
        F.lead("doc_id").over(line).alias("next_id"),
        F.lead("text").over(line).alias("next_text"),
    )


def edit_report(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_chars, edited_sha256, fingerprint and edited_fingerprint (32 hex digits),
    near_edited, near_next, next_id, fp_a and fp_b (the fingerprint as two longs).

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many (or all) of the next
    document. A null text counts as empty; the empty text's fingerprint is zero. A single document is its own next
    one. Repeated rows follow one another. An empty table gives no rows; other columns of docs are ignored.
    """
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.char_length("text") - half),
        F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half),
    )
    keys = ["range_no", "seq", "which", "guest", "doc_id", "n_chars", "edited_sha256", "next_id"]
    both = in_order(docs).withColumn("edited", edited).select(
        "range_no",
        "seq",
        "guest",
        "doc_id",
        F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "next_id",
        F.posexplode(F.array("text", "edited")).alias("which", "t"),
    )
    fps = with_fingerprints(both.where("NOT guest OR which = 0"), "t", keys)
    # after a row with a text's fingerprint comes the one of its edited text, then that of the next document
    line = Window.partitionBy("range_no").orderBy("seq", "which")
    ahead = [F.lead(c, k).over(line).alias(f"{c}{k}") for c in ("fp_a", "fp_b") for k in (1, 2)]
    hex128 = lambda a, b: F.concat(votes.hex64(F.col(a)), votes.hex64(F.col(b)))
    return fps.select("*", *ahead).where("which = 0 AND NOT guest").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hex128("fp_a", "fp_b").alias("fingerprint"),
        hex128("fp_a1", "fp_b1").alias("edited_fingerprint"),
        likeness(distance(("fp_a", "fp_b"), ("fp_a1", "fp_b1"))).alias("near_edited"),
        likeness(distance(("fp_a", "fp_b"), ("fp_a2", "fp_b2"))).alias("near_next"),
        "next_id",
        "fp_a",
        "fp_b",
    )


QUERY = "op10_fingerprints"
ORACLE_SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edit report; for documents whose id is divisible by 20, also how many others of all documents have a
    fingerprint within three bits of theirs, found by the block tables (null for the rest)."""
    rows = written(edit_report(table(spark, sf_dir, "documents")), "fingerprints")
    asked = F.coalesce(F.col("doc_id") % 20 == 0, F.lit(False))
    found = neighbour_counts(rows.where(asked), rows)
    told = rows.where(asked).join(found, ["fp_a", "fp_b"]).withColumn("neighbours", F.col("neighbours") - 1)
    rest = rows.where(~asked).withColumn("neighbours", F.lit(None).cast("bigint"))
    return told.unionByName(rest).drop("fp_a", "fp_b")
