"""Substring dedup with a log-structured index of window fingerprints.

A window is WINDOW consecutive words. Its anchor is the least hash among the runs of HALF words inside it, so windows
with equal words have equal anchors wherever they occur, and a document has about one anchor for 13 windows. The index
holds the anchors in immutable runs, sorted in buckets, and beside them which documents have them. Each new batch of
documents becomes a run and is merge-joined, bucket by bucket, with the runs before it; anchors that turn up in a second document are passed on to verification, and
when there are more than FAN runs they are compacted into one. Verification reads the texts of the documents with such
anchors and compares the windows below them by a second fingerprint, of all WINDOW words and by another hash of each: a
window is repeated only if both 64-bit fingerprints agree, so words that collide in one hash do not fool both. No window
that starts in two documents can be missed, as both have its anchor.

Documents with the same words throughout are put together by the SHA-256 of the word sequence first; only the one
with the smallest id goes into the index, the others are removed whole if they have a window at all. Windows below an
anchor that more than HOT places have are handled by minima that are combined before the shuffle; the others meet
sorted by (anchor, document), a batch at a time.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm.common import new_path, table, written

#: Words of a window, and of the runs whose least hash is the anchor.
WINDOW, HALF = 50, 25
#: Runs of the index before they are compacted; batches the query feeds it in; places of an anchor that make it hot.
FAN, BATCHES, HOT = 2, 3, 2_000
#: Documents with a null id are taken as the last of all, after every number.
LAST = (1 << 63) - 1
_CACHE = 400_000
_BASE = 0x9E3779B97F4A7C15


class _Hashes(dict):
    """Word to its row in a table of two independent 64-bit hashes. Long words are kept by a digest, which no word can
    be as it begins with a space."""

    def __init__(self):
        super().__init__()
        self.table = np.zeros((_CACHE, 2), dtype=np.uint64)

    def __missing__(self, word: bytes) -> int:
        digest = xxhash.xxh3_128_digest(word)
        key = word if len(word) <= 64 else b" " + digest
        row = self.get(key)
        if row is None:
            row = self[key] = len(self)
            self.table[row] = np.frombuffer(digest, dtype=np.uint64)
        return row

    def of(self, words: list[bytes]) -> np.ndarray:
        """The hashes of words, a row each; emptied when what may be new does not fit."""
        out = np.empty((len(words), 2), dtype=np.uint64)
        for k in range(0, len(words), _CACHE // 4):
            part = words[k : k + _CACHE // 4]
            if len(self) + len(part) > _CACHE:
                self.clear()
            out[k : k + len(part)] = self.table[np.fromiter(map(self.__getitem__, part), dtype=np.int64, count=len(part))]
        return out


@functools.lru_cache(maxsize=1)
def _hashes() -> _Hashes:
    return _Hashes()


def split(text: str | None) -> list[bytes]:
    """The words of a whole text; bytes.split() cuts at just the six spaces."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def _runs(values: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hashes of all runs of `length` values, by doubling."""
    out, have, part, size = None, 0, values, 1
    rest = length
    while rest:
        if rest & 1:
            if out is None:
                out, have = part, size
            else:
                n = len(values) - have - size + 1
                out = out[:n] * np.uint64(pow(_BASE, size, 1 << 64)) + part[have : have + n]
                have += size
        rest >>= 1
        if rest:
            n = len(part) - size
            part = part[:n] * np.uint64(pow(_BASE, size, 1 << 64)) + part[size : size + n]
            size *= 2
    return out


def _scrambled(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def windows(words: list[bytes], window: int = WINDOW, half: int = HALF) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, fingerprint) of the window that starts at each word, both as signed 64-bit integers, from two hashes of
    the words that have nothing in common."""
    if len(words) < window:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    values = _hashes().of(words)
    whole = _scrambled(_runs(values[:, 1].copy(), window))
    low, span = _scrambled(_runs(values[:, 0].copy(), half)), 1
    inside = window - half + 1
    while span * 2 <= inside:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < inside:
        low = np.minimum(low[: len(whole)], low[inside - span : inside - span + len(whole)])
    return low[: len(whole)].view(np.int64), whole.view(np.int64)


def _lists(parts: list[np.ndarray], kind=np.int64) -> pa.Array:
    offsets = np.cumsum([0] + [len(p) for p in parts]).astype(np.int32)
    values = np.concatenate(parts) if parts else np.empty(0, kind)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(kind)))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests, anchors = [], [], []
        texts = batch.column(2)
        for k in range(len(texts)):
            words = split(texts[k].as_py())
            joined = b" ".join(words)
            counts.append(len(words))
            digests.append(hashlib.sha256(joined).hexdigest())
            anchors.append(np.unique(windows(words)[0]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(counts, pa.int64()),
                pa.array(digests, pa.string()),
                _lists(anchors),
            ],
            names=["place", "row_key", "n_words", "sha256", "anchors"],
        )


def _rows(docs: DataFrame) -> DataFrame:
    """(place, row_key, text): the id that orders a document, and a key that tells rows with one id apart."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("place"),
        F.xxhash64(F.lit("row"), F.coalesce("text", F.lit(""))).alias("row_key"),
        "text",
    )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts = batch.column(2)
        packed = [press.compress((texts[k].as_py() or "").encode("utf-8", "surrogatepass")) for k in range(len(texts))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["place", "row_key", "packed"]
        )


def packed(docs: DataFrame) -> DataFrame:
    """The texts, compressed before they are shuffled."""
    return _rows(docs).mapInArrow(_packed, "place bigint, row_key bigint, packed binary")


def _unpack(value: pa.Scalar) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(value.as_py()).split()


class Index:
    """Immutable runs of (anchor, n), each anchor once with the number of its rows, sorted by anchor within buckets by
    anchor, so that a run and a new batch are merge-joined bucket by bucket, without a shuffle of the run. Numbers are
    added up before the shuffle that makes a run, so a very common anchor is one small row. The rows themselves
    (anchor, place, row_key) lie beside the runs as they came, unshuffled, for the anchors that are asked for.

    path names the index; it has a manifest, of which each state is a row, the last one counts. One that exists is
    opened with its runs and buckets, so batches can be added in other sessions. A run that was written but is not in
    the manifest, as its job died, is ignored. One writer at a time.
    """

    _RUN, _ROW = "anchor bigint, n bigint", "anchor bigint, place bigint, row_key bigint"
    _MANIFEST = "version int, buckets int, window int, half int, runs array<string>, rows array<string>"

    def __init__(self, spark: SparkSession, path: str | None = None, fan: int = FAN, buckets: int | None = None):
        self.spark, self.fan, self.path = spark, fan, path or new_path(spark, "index")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.version, self.runs, self.rows, self._tables = 0, [], [], {}
        states = self._states() if path else []
        if states:
            last = max(states, key=lambda r: r.version)
            if (last.window, last.half) != (WINDOW, HALF):
                raise ValueError(f"the index is of {last.window} words with runs of {last.half}")
            self.version, self.buckets, self.runs, self.rows = last.version, last.buckets, list(last.runs), list(last.rows)

    def _states(self) -> list:
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest")
        there = where.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(where)
        return self.spark.read.schema(self._MANIFEST).parquet(f"{self.path}/manifest").collect() if there else []

    def _commit(self) -> None:
        self.version += 1
        row = [(self.version, self.buckets, WINDOW, HALF, self.runs, self.rows)]
        self.spark.createDataFrame(row, self._MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")

    def _new_path(self, tag: str) -> str:
        return f"{self.path}/{tag}-{uuid.uuid4().hex}"

    def _write(self, counted: DataFrame) -> str:
        path = self._new_path("run")
        name = "trailmark_" + path.rsplit("-", 1)[1]
        if self.buckets != int(self.spark.conf.get("spark.sql.shuffle.partitions")):
            counted = counted.repartition(self.buckets, "anchor")
        ordered = counted.write.bucketBy(self.buckets, "anchor").sortBy("anchor")
        ordered.option("path", path).format("parquet").saveAsTable(name)
        self._tables[path] = name
        return path

    def run(self, path: str) -> DataFrame:
        """A run as a bucketed table, known to the session's catalogue from its first use on."""
        if path not in self._tables:
            name = "trailmark_" + path.rsplit("-", 1)[1]
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({self._RUN}) USING parquet CLUSTERED BY (anchor) SORTED BY (anchor)"
                f" INTO {self.buckets} BUCKETS LOCATION '{path}'"
            )
            self._tables[path] = name
        return self.spark.table(self._tables[path])

    def entries(self, anchors: DataFrame) -> DataFrame:
        """The rows of some anchors (column anchor, each once)."""
        return self.spark.read.schema(self._ROW).parquet(*self.rows).join(anchors, "anchor")

    def add(self, rows: DataFrame) -> DataFrame:
        """Adds a batch, (anchor, place, row_key) without repeats; returns its anchors that now are in two documents or
        more (column anchor, each once)."""
        kept = self._new_path("rows")
        rows.write.parquet(kept)
        path = self._write(self.spark.read.schema(self._ROW).parquet(kept).groupBy("anchor").agg(F.count(F.lit(1)).alias("n")))
        new = self.run(path)
        known = new.withColumn("seen", F.col("n") > 1)
        for k, old in enumerate(self.runs):
            side = self.run(old).select("anchor", F.lit(True).alias(f"in_{k}"))
            known = known.join(side.hint("merge"), "anchor", "left").withColumn("seen", F.col("seen") | F.coalesce(f"in_{k}", F.lit(False)))
        found = written(known.where("seen").select("anchor"), "repeated-anchors")
        self.runs.append(path)
        self.rows.append(kept)
        if len(self.runs) > self.fan:
            # read as plain files: a group over a union of bucketed scans may find an anchor in two partitions
            every = self.spark.read.schema(self._RUN).parquet(*self.runs)
            self.runs = [self._write(every.groupBy("anchor").agg(F.sum("n").alias("n")))]
        self._commit()
        return found

    def close(self) -> None:
        """Takes the runs out of the session's catalogue; their files stay."""
        for name in self._tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._tables = {}


def _below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (place, row_key, packed, hits): the windows below the anchors in hits, a row for each stretch of them."""
    for batch in batches:
        places, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        texts, hits = batch.column(2), batch.column(3)
        out: list[list[np.ndarray]] = [[], [], [], []]
        parts: list[np.ndarray] = []
        held = 0
        for k in range(len(texts)):
            wanted = np.sort(hits[k].values.to_numpy(zero_copy_only=False))
            anchor, whole = windows(_unpack(texts[k]))
            at = np.searchsorted(wanted, anchor)
            inside = wanted[np.minimum(at, len(wanted) - 1)] == anchor
            index = np.flatnonzero(inside)
            if len(index):
                cut = np.flatnonzero((np.diff(index) != 1) | (np.diff(anchor[index]) != 0)) + 1
                begins = np.concatenate([[0], cut])
                out[0].append(anchor[index[begins]])
                out[1].append(np.full(len(begins), places[k]))
                out[2].append(np.full(len(begins), keys[k]))
                out[3].append(index[begins])
                parts.extend(np.split(whole[index], cut))
                held += len(index)
            if parts and (held > 2_000_000 or k + 1 == len(texts)):
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(np.concatenate(x).astype(np.int64)) for x in out], _lists(parts)],
                    names=["anchor", "place", "row_key", "start", "prints"],
                )
                out, parts, held = [[], [], [], []], [], 0


_BELOW = "anchor bigint, place bigint, row_key bigint, start bigint, prints array<bigint>"


def _intervals(place, key, start, covered) -> pa.RecordBatch | None:
    """Merged word intervals [begin, stop) of covered windows, per stretch order of the input."""
    at = np.flatnonzero(covered)
    if not len(at):
        return None
    place, key, start = place[at], key[at], start[at]
    cut = np.flatnonzero((np.diff(place) != 0) | (np.diff(key) != 0) | (np.diff(start) != 1)) + 1
    a, b = np.concatenate([[0], cut]), np.concatenate([cut, [len(at)]]) - 1
    columns = [place[a], key[a], start[a], start[b] + WINDOW]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["place", "row_key", "begin", "stop"])


def _first_come(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of _below sorted by (anchor, place): intervals of windows that an earlier place has under that anchor."""

    def flush(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        lists = rows.column("prints").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        row = np.repeat(np.arange(rows.num_rows), sizes)
        prints = lists.values.to_numpy()[lists.offsets[0].as_py() : lists.offsets[-1].as_py()]
        anchor, place, key, start = (rows.column(c).to_numpy()[row] for c in ("anchor", "place", "row_key", "start"))
        first_of_row = np.cumsum(sizes) - sizes
        start = start + np.arange(len(row)) - first_of_row[row]
        order = np.lexsort((place, prints, anchor))
        a, p, d = anchor[order], prints[order], place[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (p[1:] != p[:-1])])
        least = d[np.maximum.accumulate(np.where(new, np.arange(len(d)), 0))]
        covered = np.empty(len(d), bool)
        covered[order] = least < d
        found = _intervals(place, key, start, covered)
        if found is not None:
            yield found

    held: list[pa.RecordBatch] = []
    for batch in batches:
        anchors = batch.column(0).to_numpy()
        if not len(anchors):
            continue
        last = np.flatnonzero(np.diff(anchors) != 0)
        if held and held[-1].column(0)[-1].as_py() != anchors[0]:
            cut = 0
        elif len(last):
            cut = int(last[0]) + 1
        else:
            held.append(batch)
            continue
        if held or cut:
            yield from flush(pa.Table.from_batches([*held, batch.slice(0, cut)]))
        rest = batch.slice(cut)
        last = np.flatnonzero(np.diff(rest.column(0).to_numpy()) != 0)
        end = int(last[-1]) + 1 if len(last) else 0
        if end:
            yield from flush(pa.Table.from_batches([rest.slice(0, end)]))
        held = [rest.slice(end)]
    if held:
        yield from flush(pa.Table.from_batches(held))


def _common(rows: DataFrame) -> DataFrame:
    """The same for hot anchors, by the minimum of each window, combined before the shuffle."""
    each = rows.select("anchor", "place", "row_key", "start", F.posexplode("prints").alias("n", "print"))
    least = each.groupBy("anchor", "print").agg(F.min("place").alias("least"))
    late = each.join(least, ["anchor", "print"]).where("least < place")
    return late.select(
        "place", "row_key", (F.col("start") + F.col("n")).alias("begin"), (F.col("start") + F.col("n") + WINDOW).alias("stop")
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (place, row_key, packed, spans): the words left when the spans are taken out."""
    for batch in batches:
        texts, spans = batch.column(2), batch.column(3)
        removed, kept = [], []
        for k in range(len(texts)):
            words = _unpack(texts[k])
            stay = np.zeros(len(words) + 1, np.int32)
            flat = spans[k].values
            np.add.at(stay, flat.field("begin").to_numpy(), 1)
            np.add.at(stay, flat.field("stop").to_numpy(), -1)
            keep = np.flatnonzero(np.cumsum(stay[:-1]) == 0)
            removed.append(len(words) - len(keep))
            kept.append(b" ".join([words[i] for i in keep.tolist()]).decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
            names=["place", "row_key", "n_removed", "kept_text"],
        )


def sketches(docs: DataFrame) -> DataFrame:
    """A row for each row of docs: its words' number and SHA-256, and its anchors; written once."""
    schema = "place bigint, row_key bigint, n_words bigint, sha256 string, anchors array<bigint>"
    return written(_rows(docs).mapInArrow(_sketch, schema), "sketches")


def repeated_spans(docs: DataFrame, rows: DataFrame, batches: int = BATCHES, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(spans, copies) from docs and their sketches: spans has the word intervals of repeated windows, (place,
    row_key, spans), of documents that are in the index; copies the (place, row_key) of documents whose words are
    those of a document with a smaller id."""
    spark = docs.sparkSession
    heads = rows.where(f"n_words >= {WINDOW}").groupBy("sha256").agg(F.min("place").alias("head"))
    told = rows.where(f"n_words >= {WINDOW}").select("place", "row_key", "sha256").join(heads, "sha256")
    told = written(told.select("place", "row_key", "head").distinct(), "heads")
    copies = told.where("place > head").select("place", "row_key")
    heads_only = told.where("place = head").select("place", "row_key")
    entries = rows.join(heads_only, ["place", "row_key"], "left_semi").select(
        F.explode("anchors").alias("anchor"), "place", "row_key"
    )
    index, found = Index(spark), None
    at = rows.agg(F.percentile_approx("place", [k / batches for k in range(1, batches)], 1000)).first()[0] or []
    edges = [None, *sorted(set(at)), None]
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        part = entries
        if low is not None:
            part = part.where(F.col("place") > low)
        if high is not None:
            part = part.where(F.col("place") <= high)
        new = index.add(part.distinct())
        found = new if found is None else found.unionByName(new)
    hits = index.entries(found.distinct())
    counts = hits.groupBy("anchor").agg((F.count(F.lit(1)) > hot).alias("hot"))
    by_doc = written(
        hits.join(counts, "anchor")
        .groupBy("place", "row_key")
        .agg(
            F.collect_list(F.when(~F.col("hot"), F.col("anchor"))).alias("cold"),
            F.collect_list(F.when(F.col("hot"), F.col("anchor"))).alias("hot"),
        ),
        "hits",
    )
    index.close()
    texts = packed(docs)
    both = texts.join(by_doc, ["place", "row_key"]).select("place", "row_key", "packed", "cold", "hot")
    cold = both.where("size(cold) > 0").select("place", "row_key", "packed", "cold").mapInArrow(_below, _BELOW)
    cold = cold.repartition("anchor").sortWithinPartitions("anchor", "place")
    spans = cold.mapInArrow(_first_come, "place bigint, row_key bigint, begin bigint, stop bigint")
    hot_rows = both.where("size(hot) > 0").select("place", "row_key", "packed", "hot").mapInArrow(_below, _BELOW)
    spans = spans.unionByName(_common(hot_rows))
    by_doc = spans.groupBy("place", "row_key").agg(F.collect_set(F.struct("begin", "stop")).alias("spans"))
    return written(by_doc, "spans"), copies


def without_repeats(docs: DataFrame, batches: int = BATCHES, hot: int = HOT) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, kept_text (null where nothing or everything is removed)
    and kept_sha256.

    Words covered by a window that also starts in a document with a smaller doc_id are removed; a document with a null
    id counts as the last of all, rows with one id as one document. Null texts have no words. Other columns of docs
    are ignored; an empty table gives no rows.
    """
    rows = sketches(docs)
    spans, copies = repeated_spans(docs, rows, batches, hot)
    cut = packed(docs).join(spans, ["place", "row_key"]).select("place", "row_key", "packed", "spans")
    cut = cut.dropDuplicates(["place", "row_key"]).mapInArrow(
        _cut, "place bigint, row_key bigint, n_removed bigint, kept_text string"
    )
    out = rows.select("place", "row_key", "n_words", "sha256").join(cut, ["place", "row_key"], "left")
    out = out.join(copies.withColumn("copy", F.lit(True)), ["place", "row_key"], "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        F.when(F.col("place") != LAST, F.col("place")).alias("doc_id"),
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("bigint"))).alias("n_removed"),
        F.when(F.col("copy").isNull(), F.col("kept_text")).alias("kept_text"),
        F.when(F.col("copy"), F.lit(nothing))
        .when(F.col("n_removed").isNotNull(), F.sha2(F.col("kept_text").cast("binary"), 256))
        .otherwise(F.col("sha256"))
        .alias("kept_sha256"),
    )


QUERY = "op3_substrings"

ORACLE_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), starts AS (
  SELECT doc_id, unnest(range(1, len(ws) - 48)) AS s, ws FROM w WHERE len(ws) >= 50
), prints AS (SELECT doc_id, s, sha256(array_to_string(ws[s:s + 49], ' ')) AS p FROM starts),
late AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY p) AS least FROM prints) WHERE least < doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM late
), words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
left_over AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY i) AS kept
  FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN left_over USING (doc_id)
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).drop("kept_text")
