from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from basketry.functions import normalize_code, number_text, pad_code
from basketry.operators import normalized_codes

GOLDEN = [
    ("EAN 07790895000218-9999999", "x", "07790895000218"),
    ("1234567890123456", "x", "12345678901234"),
    ("7790895", "x", "00000007790895"),
    ("x123456", "SKU1", None),
    ("", "SKU1", None),
    (None, "1 2 3", "00000000000123"),
    (None, "a-b_c[d]^e`f\\g h.i", "a-b_c[d]^e`f\\g"),
    (None, None, None),
]


def test_normalize_code_golden(spark):
    df = spark.createDataFrame(
        [(i, g, c) for i, (g, c, _) in enumerate(GOLDEN)], "id long, gtin string, integration_code string"
    )
    found = {r.id: r.code for r in normalized_codes(df).collect()}
    assert found == {i: want for i, (_, _, want) in enumerate(GOLDEN)}


def test_unmatched_code_is_null_not_zeros(spark):
    df = spark.range(1).select(normalize_code(F.lit("12"), F.lit("9")).alias("c"))
    assert df.first().c is None


def test_pad_code_cuts_long_codes(spark):
    df = spark.range(1).select(pad_code(F.lit("1" * 16)).alias("a"), pad_code(F.lit("7")).alias("b"))
    assert tuple(df.first()) == ("1" * 14, "0" * 13 + "7")


@pytest.mark.parametrize(
    ("value", "text"),
    [(2.0, "2"), (1.5, "1.5"), (10.0, "10"), (0.0005, "0.0005"), (123456750.0, "123456750"),
     (123456789.25, "123456789.25"), (4 / 3, repr(4 / 3)), (0.0, "0"), (100.25, "100.25")],
)
def test_number_text_is_plain_and_exact(spark, value, text):
    found = spark.createDataFrame([(value,)], "v double").select(number_text(F.col("v"))).first()[0]
    assert found == text
    assert float(found) == value
