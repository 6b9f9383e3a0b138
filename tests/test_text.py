"""Scalar functions on hand-written rows."""

import pytest
from pyspark.sql import functions as F

from skein.functions import text as tx


def one(spark, col, value, ddl="s STRING"):
    return spark.createDataFrame([(value,)], ddl).select(col).first()[0]


def test_post_date_and_iso(spark):
    ts = one(spark, F.unix_timestamp(tx.parse_post_date("s")), "Fri Dec 06 18:09:05 +0000 2024")
    assert ts == 1733508545
    assert one(spark, tx.parse_post_date("s"), "not a date") is None
    assert one(spark, tx.iso(F.col("s").cast("timestamp")), "2024-12-06 18:09:05") == "2024-12-06T18:09:05+00:00"


def test_chicago_to_utc(spark):
    assert one(spark, tx.iso(tx.chicago_to_utc(F.col("s").cast("timestamp"))), "2024-05-01 10:00:00") == \
        "2024-05-01T15:00:00+00:00"


def test_str_to_bool(spark):
    assert one(spark, tx.str_to_bool("s"), "YES") is True and one(spark, tx.str_to_bool("s"), "off") is False
    with pytest.raises(Exception):
        one(spark, tx.str_to_bool("s"), "maybe")


def test_clean_and_squeeze(spark):
    assert one(spark, tx.clean_post("s"), "['a  b',\n 'c']") == "'ab', 'c'"
    assert one(spark, tx.squeeze_query("s"), "\n (a)   OR\tb \n") == "(a)  OR b"


def test_words_and_ids(spark):
    assert one(spark, tx.words("s"), "  Air  Quality\tNOW ") == ["air", "quality", "now"]
    assert one(spark, tx.words("s"), "   ") == []
    assert one(spark, tx.id_list_append("s", F.lit("t3")), "t1;t2") == "t1;t2;t3"
    assert one(spark, tx.id_list_append("s", F.lit("t1")), "t1;t2") == "t1;t2"


def test_parse_category(spark):
    assert one(spark, tx.parse_category("s"), '{"category": "Media"}') == "media"
    assert one(spark, tx.parse_category("s"), "so: {'category': 'politicians'}") == "politicians"
    assert one(spark, tx.parse_category("s"), '{"category": "chef"}') is None


def test_word_chars_are_unicode(spark):
    assert one(spark, tx.word_chars("s"), "Bogotá, niño_2! 東京") == ["Bogotá", "niño_2", "東京"]
