"""Streaming forms of the operators, on Structured Streaming."""

from __future__ import annotations

import json
import logging
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from trailmark.functions import scalars as S
from trailmark.operators import attribution as A

LOG = logging.getLogger(__name__)


def tumbling_counts(df: DataFrame, event_time: str, keys: list[str], width: str = "1 hour") -> DataFrame:
    """Counts by window and key, given out when the watermark has passed a window (append mode)."""
    w = F.window(event_time, width)
    return df.groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("window_start"), *keys, "n"
    )


def cumulative_counts(df: DataFrame, event_time: str, keys: list[str], step: str = "1 hour") -> DataFrame:
    """Counts from the day's start to the end of each step up to the day's end."""
    ts = F.col(event_time)
    first = F.window(ts, step).end
    day_end = F.date_trunc("day", ts) + F.expr("INTERVAL 1 DAY")
    ends = F.explode(F.sequence(first, day_end, F.expr(f"INTERVAL {step}")))
    return df.withColumn("window_end", ends).groupBy("window_end", *keys).agg(F.count(F.lit(1)).alias("n"))


def split_late(batch: DataFrame, event_time: str, watermark_ms: int) -> tuple[DataFrame, DataFrame]:
    """(on time, late) rows of a micro-batch; Spark's own operators drop late rows without a trace."""
    late = F.unix_millis(F.col(event_time)) < watermark_ms
    return batch.where(~late), batch.where(late)


def sentinel(df: DataFrame, event_time: str, flag: str = "is_sentinel") -> DataFrame:
    """A copy of one row far in the future, flagged; fed at the end of a bounded replay, it moves the watermark past
    all windows. Consumers filter the flag."""
    one = df.limit(1).withColumn(event_time, F.lit("2200-01-01 00:00:00").cast(df.schema[event_time].dataType))
    return df.withColumn(flag, F.lit(False)).unionByName(one.withColumn(flag, F.lit(True)))


def _as_of(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Facts wait until the watermark has passed them, then take the last version at or before their time."""
    facts, versions = state.get if state.exists else ([], [])
    facts, versions = list(facts), list(versions)
    for frame in frames:
        for row in frame.itertuples(index=False):
            if row.is_fact:
                facts.append((int(row.ms), row.fact))
            else:
                versions.append((int(row.ms), row.version))
    versions.sort()
    now = state.getCurrentWatermarkMs()
    ready, waiting = [f for f in facts if f[0] < now], [f for f in facts if f[0] >= now]
    out = []
    times = [at for at, _ in versions]
    for ms, fact in sorted(ready):
        n = bisect_right(times, ms)
        if n:
            out.append((*key, ms, fact, versions[n - 1][1]))
    # of versions before the watermark only the last can still be asked for
    old = [v for v in versions if v[0] < now]
    versions = old[-1:] + [v for v in versions if v[0] >= now]
    state.update(([list(f) for f in waiting], [list(v) for v in versions]))
    if waiting:
        state.setTimeoutTimestamp(max(now + 1, min(f[0] for f in waiting) + 1))
    yield pd.DataFrame(out, columns=["k", "ms", "fact", "version"])


def as_of_stream(events: DataFrame) -> DataFrame:
    """Inner as-of join of a tagged stream: k string, ms bigint, is_fact boolean, fact string, version string, with a
    watermark on its event time. State per key: facts not yet passed by the watermark, and versions from then on."""
    return events.groupBy("k").applyInPandasWithState(
        _as_of,
        "k string, ms bigint, fact string, version string",
        "facts array<struct<ms: bigint, v: string>>, versions array<struct<ms: bigint, v: string>>",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )


def attribution_stream(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, before: str, after: str) -> DataFrame:
    """Explicit attribution of two watermarked streams: right rows whose id is on the left within a time bound (state
    is dropped beyond it), with the left row's time."""
    bound = (
        f"l.{key} = r.{key} AND l.{left_time} >= r.{right_time} - INTERVAL {before}"
        f" AND l.{left_time} <= r.{right_time} + INTERVAL {after}"
    )
    joined = right.alias("r").join(left.alias("l"), F.expr(bound))
    return joined.select("r.*", F.col(f"l.{left_time}").alias("left_time"))


def hold_back(df: DataFrame, event_time: str, *delays_ms: int) -> DataFrame:
    """A watermark that trails by the sum of the delays. All operators of a query share one watermark, so what a later
    one needs held back is added up at the source."""
    return df.withWatermark(event_time, f"{sum(delays_ms)} milliseconds")


class LateSplitter:
    """For writeStream.foreachBatch: rows behind the watermark go to <path>/late, all others to <path>/on_time.

    The watermark is the latest time of the batches before, less the delay. It's kept in <path>/marks by batch, as the
    rows are, so a batch that is run again after a failure or a restart finds what it found before and replaces its own
    rows.
    """

    def __init__(self, path: str, event_time: str, delay_ms: int) -> None:
        self.path, self.event_time, self.delay_ms = path.rstrip("/"), event_time, delay_ms

    def table(self, spark, kind: str, schema) -> DataFrame:
        """What has been written of a kind (late or on_time); empty where nothing has."""
        return spark.read.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).parquet(f"{self.path}/{kind}")

    def _mark(self, spark, batch_id: int) -> int | None:
        if not batch_id:
            return None
        row = spark.read.schema("latest_ms bigint").parquet(f"{self.path}/marks/b{batch_id - 1}").first()
        return row.latest_ms if row else None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = self._mark(spark, batch_id)
        least = -(2**62) if before is None else before - self.delay_ms
        batch = batch.persist()
        on_time, late = split_late(batch, self.event_time, least)
        on_time.write.mode("overwrite").parquet(f"{self.path}/on_time/b{batch_id}")
        late.write.mode("overwrite").parquet(f"{self.path}/late/b{batch_id}")
        latest = F.greatest(F.max(F.unix_millis(self.event_time)), F.lit(before).cast("bigint"))
        batch.agg(latest.alias("latest_ms")).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/marks/b{batch_id}")
        batch.unpersist()


def _delayed(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    held = [tuple(x) for x in state.get[0]] if state.exists else []
    for frame in frames:
        held.extend((int(r.due), r.row) for r in frame.itertuples(index=False))
    now = state.getCurrentWatermarkMs()
    held.sort()
    n = bisect_left(held, (now,))
    state.update(([list(x) for x in held[n:]],))
    if held[n:]:
        state.setTimeoutTimestamp(max(now + 1, held[n][0] + 1))
    else:
        state.remove()
    yield pd.DataFrame(held[:n], columns=["due", "row"])


def delay_stream(events: DataFrame, key: str, event_time: str, delay_ms: int) -> DataFrame:
    """A watermarked stream's rows, given out when the watermark has passed their time by delay_ms. State: the rows held
    back, by key."""
    due = (F.unix_millis(event_time) + delay_ms).alias("due")
    kept = events.select(F.col(key).cast("string").alias("k"), F.col(event_time), due, F.to_json(F.struct(*events.columns)).alias("row"))
    out = kept.groupBy("k").applyInPandasWithState(_delayed, "due bigint, row string", "held array<struct<due: bigint, row: string>>", "append", GroupStateTimeout.EventTimeTimeout)
    return out.select(F.from_json("row", events.schema).alias("x")).select("x.*")


class SlowBatches(StreamingQueryListener):
    """Logs the micro-batches that take longer than so many milliseconds, with what they spent it on."""

    def __init__(self, limit_ms: int, log=LOG.warning) -> None:
        self.limit_ms, self.log = limit_ms, log

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        if p.batchDuration > self.limit_ms:
            self.log("slow batch %s of %s: %s ms, %s", p.batchId, p.name or p.id, p.batchDuration, dict(p.durationMs))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def _nearest(lefts: list, at: int, o: A.JoinOptions):
    """Of (ms, id) in order the one nearest to a time, the later of two as near, of equal times the smaller id."""
    n = bisect_right(lefts, (at + 1,))
    found = []
    if n:
        ms = lefts[n - 1][0]
        if ms >= at - o.max_time:
            found.append(lefts[bisect_left(lefts, (ms,))])
    if n < len(lefts) and lefts[n][0] <= at + o.max_out_of_order:
        found.append(lefts[n])
    return min(found, key=lambda x: (abs(at - x[0]), -x[0], x[1]), default=None)


def _attribute(o: A.JoinOptions):
    """The state function of `attribute_stream` for one user: lefts and waiting rights, each (ms, id, scopes, key)."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        lefts, rights = ([tuple(x) for x in part] for part in state.get) if state.exists else ([], [])
        out = []
        known = {x[1] for x in lefts}
        waiting = {x[1] for x in rights}
        for row in sorted((r for f in frames for r in f.itertuples(index=False)), key=lambda r: (r.ms, r.id)):
            side, ids = (rights, waiting) if row.is_right else (lefts, known)
            if row.id in ids:
                out.append((*key, row.id, int(row.ms), "", None, "duplicate_right" if row.is_right else "duplicate_left"))
            else:
                ids.add(row.id)
                side.append((int(row.ms), row.id, row.scopes, row.left_id))
        now = state.getCurrentWatermarkMs()
        ready = sorted(r for r in rights if r[0] + o.max_out_of_order < now)
        rights = [r for r in rights if r[0] + o.max_out_of_order >= now]
        by_id = {x[1]: x[0] for x in lefts}
        by_scope: dict[str, list] = {}
        if any(not r[3] for r in ready):
            for ms, ident, scopes, _ in lefts:
                for token in json.loads(scopes):
                    by_scope.setdefault(token, []).append((ms, ident))
            for line in by_scope.values():
                line.sort()
        for ms, ident, scopes, left_id in ready:
            if left_id:
                at = by_id.get(left_id)
                far = o.max_time * max(1, o.retention)
                hit = None if at is None or at < ms - far or at > ms + o.max_out_of_order else (at, left_id)
                kind = "explicit"
            else:
                hit, kind = None, "inferred"
                for rank in json.loads(scopes):
                    near = [x for token in rank if (x := _nearest(by_scope.get(token, []), ms, o))]
                    if near:
                        hit = min(near, key=lambda x: (abs(ms - x[0]), -x[0], x[1]))
                        break
            out.append((*key, ident, ms, hit[1] if hit else "", hit[0] if hit else None, kind if hit else "none" if o.how == "right" else "dropped"))
        # lefts go when no right row that may still come or wait can look back to them
        keep = min([now, *[r[0] for r in rights]]) - o.max_time * max(1, o.retention)
        lefts = [x for x in lefts if x[0] >= keep]
        if lefts or rights:
            state.update(([list(x) for x in lefts], [list(x) for x in rights]))
            next_ = min([r[0] + o.max_out_of_order for r in rights], default=min((x[0] for x in lefts), default=0) + o.max_time * max(1, o.retention))
            state.setTimeoutTimestamp(max(now, next_) + 1)
        elif state.exists:
            state.remove()
        names = ["platform_id", "log_user_id", "id", "ms", "left_key", "left_ms", "kind"]
        yield pd.DataFrame(out, columns=names).astype({"left_ms": "Int64"})

    return run


def attribution_events(left: DataFrame, right: DataFrame, o: A.JoinOptions, right_id: str) -> DataFrame:
    """The tagged events of both sides that `attribute_stream` reads; ts is their time."""
    any_ = F.array(F.lit(""))
    token = lambda s, c: F.concat_ws(S.PART, s["kind"], s["id"], c)
    real = lambda df: F.filter(A._scopes(df, o), lambda s: ~S.blank(s["id"]))
    l_contents = F.array_union(any_, A.contents(left)) if o.use_contents else any_
    r_contents = F.when(F.size(A.contents(right)) > 0, A.contents(right)).otherwise(any_) if o.use_contents else any_
    l_scopes = F.array_distinct(F.flatten(F.transform(real(left), lambda s: F.transform(l_contents, lambda c: token(s, c)))))
    r_scopes = F.transform(real(right), lambda s: F.transform(r_contents, lambda c: token(s, c)))

    def side(df: DataFrame, ident: str, is_right: bool, scopes, left_id) -> DataFrame:
        return df.where(~S.blank(F.col(ident))).select(*A.USER, F.timestamp_millis("ms").alias("ts"), "ms", F.lit(is_right).alias("is_right"), F.col(ident).alias("id"), F.to_json(scopes).alias("scopes"), left_id.alias("left_id"))

    return side(left, o.key, False, l_scopes, F.lit("")).unionByName(side(right, right_id, True, r_scopes, F.coalesce(F.col(o.key), F.lit(""))))


def attribute_stream(events: DataFrame, o: A.JoinOptions) -> DataFrame:
    """`operators.attribution.attribute` on a stream of `attribution_events`, watermarked on ts: (user key, id, ms,
    left_key, left_ms, kind). A right row waits until the watermark has passed it by max_out_of_order. kind is explicit,
    inferred, and for the side tables dropped (none in a right join), duplicate_left or duplicate_right. Rows behind the
    watermark never come here: a LateSplitter before this keeps them.

    Unlike the batch form a join by id looks back max_time, or retention times that, as state must end. State per user:
    lefts as far back as a right row can look, and waiting rights; it goes by timer when they do.
    """
    return events.groupBy(*A.USER).applyInPandasWithState(
        _attribute(o),
        "platform_id bigint, log_user_id string, id string, ms bigint, left_key string, left_ms bigint, kind string",
        "lefts array<struct<ms: bigint, id: string, scopes: string, left_id: string>>, rights array<struct<ms: bigint, id: string, scopes: string, left_id: string>>",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
