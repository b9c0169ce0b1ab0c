"""Filters and validation rules. A filter gives both sides; an invalid record gives one error row per failed rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.functions import scalars as S


def partition_by(df: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that match, rows that don't); null counts as no match."""
    sure = F.coalesce(keep, F.lit(False))
    return df.where(sure), df.where(~sure)


def traffic_priority(traffic: Column) -> Column:
    """3 for production and unknown traffic, 2 for shadow, 1 for tests and replays."""
    return F.when(traffic == "SHADOW", 2).when(traffic.isin("LOAD_TEST", "INTERNAL", "REPLAY"), 1).otherwise(3)


def should_join(traffic: Column) -> Column:
    return traffic_priority(traffic) > 1


def ignores_usage(*flags: Column) -> Column:
    """Whether any of the nested records asks to be ignored."""
    out = F.lit(False)
    for f in flags:
        out = out | F.coalesce(f, F.lit(False))
    return out


def is_joined_impression(action: Column) -> Column:
    """Whether a joined event is an impression, that is without an action."""
    return action.isNull()


def is_buyer(sparse_ids: Column, hashes: list[int]) -> Column:
    """Whether none of the given features is 1."""
    out = F.lit(True)
    for h in hashes:
        out = out & (F.coalesce(F.try_element_at(sparse_ids, F.lit(h)), F.lit(0)) != 1)
    return out


def matches_ids(ids: dict[str, set[str]], columns: dict[str, str]) -> Column:
    """Whether any of the named columns contains one of the substrings asked for under its kind."""
    out = F.lit(False)
    for kind, wanted in ids.items():
        for w in sorted(wanted):
            out = out | F.coalesce(F.col(columns[kind]).contains(w), F.lit(False))
    return out


def _rule(failed: Column, error: str, field: str) -> Column:
    return F.when(failed, F.struct(F.lit(error).alias("error_type"), F.lit(field).alias("field")))


def action_errors() -> Column:
    """Rules of actions: log_user_id, content_id, impression_id, insertion_id, cart array<struct<content_id, quantity>>."""
    none = S.blank(F.col("impression_id")) & S.blank(F.col("insertion_id")) & S.blank(F.col("content_id"))
    cart = F.coalesce(F.col("cart"), F.array().cast("array<struct<content_id:string,quantity:bigint>>"))
    none = none & ~F.exists(cart, lambda c: ~S.blank(c["content_id"]))
    return F.array_compact(
        F.array(
            _rule(S.blank(F.col("log_user_id")), "MISSING_FIELD", "LOG_USER_ID"),
            _rule(none, "MISSING_JOINABLE_ID", "MULTIPLE"),
            _rule(F.exists(cart, lambda c: c["quantity"] == 0), "MISSING_FIELD", "CART_CONTENT_QUANTITY"),
            _rule(F.exists(cart, lambda c: S.blank(c["content_id"])), "MISSING_FIELD", "CART_CONTENT_ID"),
        )
    )


def impression_errors() -> Column:
    none = S.blank(F.col("insertion_id")) & S.blank(F.col("content_id"))
    return F.array_compact(
        F.array(_rule(S.blank(F.col("log_user_id")), "MISSING_FIELD", "LOG_USER_ID"), _rule(none, "MISSING_JOINABLE_ID", "MULTIPLE"))
    )


def delivery_errors() -> Column:
    """Rules of delivery logs: log_user_id, insertion_matrix_headers, insertion_matrix."""
    ragged = F.exists("insertion_matrix", lambda row: F.size(row) != F.size("insertion_matrix_headers"))
    return F.array_compact(
        F.array(_rule(S.blank(F.col("log_user_id")), "MISSING_FIELD", "LOG_USER_ID"), _rule(ragged, "INVALID", "INSERTION_MATRIX"))
    )


def required_errors(column: str, field: str) -> Column:
    """The rule of views (log user) and users (user)."""
    return F.array_compact(F.array(_rule(S.blank(F.col(column)), "MISSING_FIELD", field)))


def validated(df: DataFrame, errors: Column, record: str, ids: list[str]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, error rows with record_type, error_type, field and the ids)."""
    marked = df.withColumn("__errors", errors)
    bad = marked.select(F.lit(record).alias("record_type"), *ids, F.explode("__errors").alias("e")).select("record_type", "e.error_type", "e.field", *ids)
    return marked.where(F.size("__errors") == 0).drop("__errors"), bad
