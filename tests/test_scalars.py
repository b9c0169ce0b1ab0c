import re

import pytest
from pyspark.sql import functions as F

from trailmark.functions import scalars as S
from trailmark.sources import files, sinks


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{k}") for k, c in enumerate(cols)]).first()


def test_xxh64_vectors(spark):
    row = one(spark, S.xxh64_hex(F.lit("")), S.xxh64_hex(F.lit("prom dresses")), S.query_hash(F.lit("")))
    assert row[0] == "ef46db3751d8e999"
    assert row[1] == "2633a713effe6bda"
    assert row[2] == -1205034819632174695


def test_java_hash_code(spark):
    row = one(spark, S.java_hash_code(F.lit("hello")), S.java_hash_code(F.lit("")), S.java_hash_code(F.lit("polygenelubricants")))
    assert tuple(row) == (99162322, 0, -2147483648)


@pytest.mark.parametrize(
    "fid,kind,metric,window",
    [(1056802, "ITEM_DEVICE_COUNT", 1 << 5, "HOUR"), (1237060, "LOG_USER_COUNT", 2 << 5, "DAY")],
)
def test_feature_ids(spark, fid, kind, metric, window):
    row = one(spark, S.feature_id(kind, F.lit(metric), window), *S.feature_parts(F.lit(fid)).values())
    assert tuple(row) == (fid, S.TYPE_BITS[kind], metric, S.WINDOW_BITS[window])


def test_absence_rules(spark):
    row = one(
        spark, S.first_not_empty(F.lit(""), F.lit(None), F.lit("b")), S.merged(F.lit(""), F.lit("r"), ""),
        S.merged(F.lit(5), F.lit(6), 0), S.merged(F.lit(0), F.lit(None).cast("int"), 0), S.blank(F.lit("  ")), S.blank(F.lit(None)),
    )
    assert tuple(row) == ("b", "r", 5, 0, True, True)


def test_key_bytes_and_store_keys(spark):
    row = one(spark, S.user_key_bytes(F.lit(258).cast("bigint"), F.lit("é")), S.store_key(F.lit(1), F.lit("a")))
    assert bytes(row[0]) == (258).to_bytes(8, "little") + "é".encode()
    assert row[1] == "1\x1fa"


def test_java_hash_code(spark):
    def java(text):
        h = 0
        units = text.encode("utf-16-be")
        for k in range(0, len(units), 2):
            h = (h * 31 + int.from_bytes(units[k : k + 2], "big")) % 2**32
        return h - 2**32 if h >> 31 else h

    for text in ("", "abc", "a much longer string than that", "é\n你", "😀", "x😀y𝄞z"):
        assert one(spark, S.java_hash_code(F.lit(text)))[0] == java(text)


def test_names_and_templates():
    assert S.fill("a {x} {y}", {"x": "1"}) == "a 1 {y}"
    assert files.topic("metrics", "view") == "metrics.view"
    assert files.topic("metrics", "view", "blue", "d") == "metrics.blue.d.view"
    assert sinks.table_path("s3://b/", "raw", "view", label="blue") == "s3://b/blue/raw/view"


def test_agents(spark):
    row = one(
        spark, S.is_bot(F.lit("Mozilla/5.0 (compatible; Googlebot/2.1)")), S.is_bot(F.lit("Mozilla/5.0 Firefox/1.0")),
        S.os_family(F.lit("x Android 9")), S.browser_family(F.lit("OPR/1 Chrome/2")), S.is_bot(F.lit(None)),
    )
    assert tuple(row) == (True, False, "Android", "Opera", False)


def test_no_subpackage_is_needed():
    """The engine does not import the training-data operators."""
    import pathlib

    root = pathlib.Path(__file__).parent.parent / "trailmark"
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert not re.search(r"(from|import)\s+trailmark\.llm|from trailmark import .*\bllm\b", path.read_text()), path
