import random

from pyspark.sql import functions as F

from subsight.functions.expr import freshness_text, one_decimal_percent_text, one_decimal_text


def test_one_decimal_rounds_the_exact_binary_value(spark):
    draw = random.Random(3)
    values = [0.0, 0.05, 0.15, 0.25, 0.35, 0.45, 0.75, 1.25, 2.5, 6.25, 12.35, 0.3 - 1e-17, 99.95, 1e-9, 123456789.05, -0.25, -1.35]
    values += [k / 20 for k in range(400)] + [draw.uniform(0, 100) for _ in range(300)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", one_decimal_text(F.col("v")).alias("t"))
    assert [(r.v, r.t) for r in rows.collect() if r.t != "%.1f" % r.v] == []


def test_texts_on_ties(spark):
    row = spark.range(1).select(
        one_decimal_percent_text(F.lit(0.0625)), freshness_text(F.lit(4500.0)), one_decimal_percent_text(F.lit(None).cast("double"))
    ).first()
    assert row[0] == "6.2%" and row[1].startswith("1.2 ") and row[2] is None
