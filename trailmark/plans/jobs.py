"""The five jobs, each a function of DataFrames with its options in a dataclass."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trailmark.functions import scalars as S
from trailmark.operators import attribution as A
from trailmark.operators import checks as K
from trailmark.operators import counters as C
from trailmark.operators import dedupe as D
from trailmark.operators import ingest
from trailmark.operators import temporal as T
from trailmark.plans import metrics
from trailmark.sources import files, sinks

#: Key of each raw table; those without one are written as they come.
RAW_KEYS = {
    "user": ["log_user_id"], "cohort_membership": ["membership_id"], "view": ["view_id"], "auto_view": ["auto_view_id"],
    "impression": ["impression_id"], "action": ["action_id"], "delivery_log": ["request_id"], "diagnostics": None,
    "session": ["session_id"], "session_profile": ["session_id"],
}


@dataclass(frozen=True)
class RawOptions:
    root: str
    label: str = ""
    codec: str = "snappy"
    fmt: str = "parquet"
    dedupe: bool = True


def raw_output(batches: DataFrame, o: RawOptions) -> dict[str, DataFrame]:
    """Typed tables without user ids and repeats, and the id side tables, by name."""
    out = {}
    for record, rows in ingest.split_all(batches).items():
        base = "request." if record == "delivery_log" else ""
        ms = F.col(f"{base}timing.event_api_timestamp")
        rows = rows.withColumn("__ms", ms).withColumn("__user", F.col(f"{base}user_info.log_user_id"))
        keys = RAW_KEYS[record]
        if o.dedupe and keys:
            key = F.concat_ws(S.PART, *[F.col("__user") if k == "log_user_id" else F.col(f"{base}{k}") for k in keys])
            rows = D.keep_first(rows.withColumn("__key", key), ["platform_id", "__key"], "__ms", ["__user"], D.RETENTION_MS.get(record, 86_400_000))
        out[record] = sinks.with_date_hour(ingest.clear_user_id(rows), F.col("__ms")).drop("__ms", "__user", "__key")
    logs = ingest.fix_response(ingest.restructure(ingest.split(batches, "delivery_log")))
    out["delivery_log_ids"] = ingest.delivery_ids(logs)
    out["request_insertion_ids"] = ingest.insertion_ids(logs, "request")
    out["response_insertion_ids"] = ingest.insertion_ids(logs, "response")
    out["log_user_user"] = ingest.log_user_users(batches).dropDuplicates(["platform_id", "log_user_id", "user_id"])
    return out


def write_raw(tables: dict[str, DataFrame], o: RawOptions) -> None:
    for name, df in tables.items():
        path = sinks.table_path(o.root, "raw" if name in RAW_KEYS else "raw-side", name, label=o.label)
        if "dt" in df.columns:
            sinks.write_dated(df, path, o.fmt, o.codec)
        else:
            df.write.mode("append").format(o.fmt).save(path)


@dataclass(frozen=True)
class FlatOptions:
    view_insertion: A.JoinOptions = A.VIEW_INSERTION
    insertion_impression: A.JoinOptions = A.INSERTION_IMPRESSION
    impression_action: A.JoinOptions = A.IMPRESSION_ACTION
    redundancy_ms: int = 86_400_000
    session_gap: str = "1 day"
    latest_window_ms: int = 21_600_000
    latest_most: int = 25


def _with_left(joined: DataFrame, left: DataFrame, key: str, ids: list[str]) -> DataFrame:
    """Attributed rows with the left event's ids beside their own, under __<id>."""
    side = left.select(*A.USER, F.col(key).alias("left_key"), *[F.col(c).alias(f"__{c}") for c in ids]).dropDuplicates([*A.USER, "left_key"])
    return joined.join(side, [*A.USER, "left_key"], "left")


def _attributed(left: DataFrame, right: DataFrame, o: A.JoinOptions, ids: list[str], probe: bool) -> DataFrame:
    """Right rows attributed by an inner join, with the left event's ids beside their own: those that name it are joined
    by id, and only the others go through the scopes. probe: looks first whether there are others."""
    named, others = A.by_id(left, right, o, ids), right.where(S.blank(F.col(o.key)))
    if probe and not others.select(F.lit(1)).limit(1).count():
        return named
    return named.unionByName(_with_left(A.attribute(left, others, o), left, o.key, ids))


def _merged(rows: DataFrame, key: str, ids: list[str]) -> DataFrame:
    """Rows of `_with_left` with the left event's ids where it has them (left wins), its key included."""
    rows = rows.withColumns({c: S.merged(F.col(f"__{c}"), F.col(c), "") for c in ids} | {key: S.merged(F.col("left_key"), F.col(key), "")})
    return rows.drop("left_key", "left_ms", "kind", *[f"__{c}" for c in ids])


def _mismatched(rows: DataFrame, ids: list[str], record: str, own: str) -> DataFrame:
    """Of rows of `_with_left`: (record_type, user key, ms, id, field, lhs, rhs) of ids that both sides have and that
    differ."""
    both = rows.select(F.lit(record).alias("record_type"), *A.USER, "ms", F.col(own).alias("id"), *ids, *[f"__{c}" for c in ids])
    return A.mismatches(both, {c: (f"__{c}", c) for c in ids})


def flat_output(views: DataFrame, insertions: DataFrame, impressions: DataFrame, actions: DataFrame, o: FlatOptions | None = None, cut=None, sides: bool = False) -> dict[str, DataFrame]:
    """The join job on narrow events: chained attribution, redundancy reduction, sessions and latest impressions.

    All inputs have the user key, ms, content_id and their ids ('' where absent); the key of every step is the user,
    so the chain stays partitioned by it. Records that break a rule of theirs are not joined. Results: insertion,
    impression, action, redundant_impression, flat_session, latest_impressions, and the side tables: dropped impressions
    and actions, validation_error, mismatch_error, and debug_partial_response_insertion (insertions without a view).
    cut(df, name) may write a step and give back what it reads, so that steps used by several results run once.
    sides: gives the side tables (FLAT_SIDES) only, without the steps that none of them is made of.
    """
    o, probe = o or FlatOptions(), cut is not None
    cut = cut or (lambda df, _: df)
    impressions, bad_impressions = K.validated(impressions, K.impression_errors(), "IMPRESSION", [*A.USER, "ms", "impression_id"])
    cart = "cart" in actions.columns
    carted = actions if cart else actions.withColumn("cart", F.lit(None).cast("array<struct<content_id:string,quantity:bigint>>"))
    actions, bad_actions = K.validated(carted, K.action_errors(), "ACTION", [*A.USER, "ms", "action_id"])
    actions = actions if cart else actions.drop("cart")
    above, shown_ids = ["request_id", "view_id", "content_id"], ["insertion_id", "request_id", "view_id"]
    busy = not probe or A.has_busy(views, insertions)
    delivered = cut(_merged(A.attribute(views, insertions, o.view_insertion, busy), "view_id", []), "delivered")
    shown = cut(_attributed(delivered, impressions, o.insertion_impression, above, probe), "shown")
    joined = _merged(shown, "insertion_id", above)
    acted = cut(_attributed(joined, actions, o.impression_action, shown_ids, probe), "acted")
    ident = lambda df, c: df.withColumnRenamed(c, "id")
    side = {
        "dropped_impression": A.dropped(impressions, shown, [*A.USER, "impression_id"]),
        "dropped_action": A.dropped(actions, acted, [*A.USER, "action_id", "content_id"]),
        "validation_error": ident(bad_impressions, "impression_id").unionByName(ident(bad_actions, "action_id")),
        "mismatch_error": _mismatched(shown, above, "IMPRESSION", "impression_id").unionByName(_mismatched(acted, shown_ids, "ACTION", "action_id")),
        "debug_partial_response_insertion": delivered.where(S.blank(F.col("view_id"))),
    }
    if sides:
        return side | {"redundant_impression": A.redundant(joined, o.redundancy_ms)}
    found = _merged(acted, "impression_id", shown_ids)
    roots, redundant, pointed = A.reduce_redundant(joined, found, o.redundancy_ms, cut)
    pointed = cut(pointed, "pointed")
    timed = lambda df: df.withColumn("ts", F.timestamp_millis("ms"))
    return side | {
        "insertion": delivered,
        "impression": roots,
        "redundant_impression": redundant,
        "action": pointed,
        "flat_session": T.sessions(timed(roots), timed(pointed), o.session_gap),
        "latest_impressions": T.latest_impressions(pointed, roots, o.latest_window_ms, o.latest_most),
    }


def user_part(parts: int, user=A.USER) -> Column:
    """The part of the users, of so many, that a row belongs to. No step of the join job looks beyond one user, so the
    job over one part after the other gives the rows of the job over all."""
    return F.pmod(F.xxhash64(*user), F.lit(parts)).cast("int")


#: The joined tables by the result they are made of, with their keys.
FLAT_KEYS = {
    "joined_impression": ("impression", ("platform_id", "insertion_id")),
    "joined_action": ("action", ("platform_id", "action_id", "content_id")),
    "flat_response_insertion": ("flat_session", ("platform_id", "insertion_id")),
}
FLAT_SIDES = ("dropped_impression", "dropped_action", "redundant_impression", "validation_error", "mismatch_error", "debug_partial_response_insertion")


def flat_tables(out: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The joined tables whose results there are, user ids cleared, with their time as ms."""
    tables = {}
    for name, (result, _) in FLAT_KEYS.items():
        if result not in out:
            continue
        df = out[result]
        if "ms" not in df.columns:
            df = df.withColumn("ms", F.unix_millis("session_start"))
        tables[name] = ingest.clear_user_id(df)
    return tables


def write_flat(out: dict[str, DataFrame], root: str, label: str = "", fmt: str = "parquet", codec: str = "snappy", late: dict[str, DataFrame] | None = None) -> dict[str, str]:
    """Writes the joined tables, the side tables and the late rows by kind (late_<kind>) under date and hour; gives the
    path of each by name. Side tables lie in etl_side."""
    paths = {}
    sides = {name: ingest.clear_user_id(out[name]) for name in FLAT_SIDES}
    sides |= {f"late_{kind}": ingest.clear_user_id(df) for kind, df in (late or {}).items()}
    for folder, tables in (("joined", flat_tables(out)), ("etl_side", sides)):
        for name, df in tables.items():
            paths[name] = sinks.table_path(root, folder, name, label=label)
            sinks.write_dated(sinks.with_date_hour(df, F.col("ms")), paths[name], fmt, codec)
    return paths


def upsert_flat(out: dict[str, DataFrame], old: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The joined tables as lake tables: new rows over old ones by the table's key, the later one wins."""
    old = old or {}
    order = lambda df: [c for c in ("ms", "impression_id", "request_id", "log_user_id") if c in df.columns]
    return {name: sinks.upsert(df, old.get(name), list(FLAT_KEYS[name][1]), order(df)) for name, df in flat_tables(out).items()}


@dataclass(frozen=True)
class CounterOptions:
    as_of_ms: int
    popular_window: str = "14 days"
    popular_slide: str = "3 days"
    popular_least: int = 1000
    families: tuple[C.Family, ...] = C.FAMILIES
    last_families: tuple[C.Family, ...] = C.LAST_FAMILIES
    exempt: tuple[str, ...] = field(default=("",))


def counter(events: DataFrame, o: CounterOptions) -> DataFrame:
    """All store commands as of one time. Families by query count only queries that were popular at the event's time;
    the empty query always passes."""
    popular = C.popular(events.where(C.query_ok(F.col("search_query"))), "rowtime", ["search_query"], o.popular_window, o.popular_slide, o.popular_least)
    gated = T.right_seen(events, popular, ["search_query"], "window_start", "window_end", "rowtime", F.col("search_query").isin(*o.exempt))
    pick = lambda f: gated if "search_query" in f.group else events
    parts = [C.family_counts(pick(f), f, o.as_of_ms) for f in o.families] + [C.last_family(pick(f), f, o.as_of_ms) for f in o.last_families]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@dataclass(frozen=True)
class MetricsOptions:
    step_hours: int = 1
    csv_sep: str = ","


def content_metrics(unified: DataFrame, o: MetricsOptions | None = None) -> dict[str, DataFrame]:
    """Hourly, daily and cumulated metrics, and the documents and messages made of the latter."""
    o = o or MetricsOptions()
    cumulated = metrics.cumulated(unified, o.step_hours)
    documents = sinks.metrics_document(cumulated)
    return {
        "hourly": metrics.hourly(unified),
        "daily": metrics.daily(unified),
        "cumulated": cumulated,
        "documents": documents,
        "messages": sinks.message_records(documents, F.col("body.content_id")),
    }


@dataclass(frozen=True)
class FixSchemaOptions:
    source: str
    target: str
    start: str
    end: str
    fmt: str = "parquet"
    defaults: dict = field(default_factory=dict)


def fix_schema(spark, schema: StructType, o: FixSchemaOptions) -> DataFrame:
    """Reads a range of dates, maps the rows to a new schema by name and writes them by date and hour."""
    rows = files.dated(spark, o.source, o.start, o.end, o.fmt)
    dated = StructType([f for f in schema.fields if f.name not in ("dt", "hour")])
    target = StructType([*dated.fields, rows.schema["dt"], rows.schema["hour"]])
    mapped = ingest.aligned(rows, target, o.defaults)
    sinks.write_dated(mapped, o.target, o.fmt)
    return mapped
