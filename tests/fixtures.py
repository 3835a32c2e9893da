"""Hand-made fixtures (FIXTURES.md §3)."""

import math

from pyspark.sql import types as T


def dirty(spark):
    """12 rows: exact duplicates, an all-null column, a constant column, a column
    with > 50 % nulls, one at exactly 50 % (not filled), a mode tie, 'x' in a
    numeric text column, +-inf and NaN."""
    inf = float("inf")
    rows = [
        # id, grp, clicks, half_null, most_null, empty, const, tie, numtext, val
        (1, "a", 1.0, 1.0, None, None, "k", "p", "1", 1.0),
        (2, "a", 2.0, None, None, None, "k", "q", "2", 2.0),
        (3, "b", None, 3.0, None, None, "k", "p", "x", inf),
        (4, "b", 4.0, None, None, None, "k", "q", "4", 4.0),
        (5, "c", 5.0, 5.0, 5.0, None, "k", None, "5", -inf),
        (6, "c", 100.0, None, None, None, "k", "r", "6", 6.0),
        (7, "a", 7.0, 7.0, None, None, "k", "r", "7", float("nan")),
        (8, "a", 8.0, None, 8.0, None, "k", "s", "8", 8.0),
        (9, "b", 9.0, 9.0, None, None, "k", "s", "9", 9.0),
        (10, "b", 10.0, None, None, None, "k", "t", "10", 10.0),
        (1, "a", 1.0, 1.0, None, None, "k", "p", "1", 1.0),
        (2, "a", 2.0, None, None, None, "k", "q", "2", 2.0),
    ]
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("grp", T.StringType()),
        T.StructField("clicks", T.DoubleType()), T.StructField("half_null", T.DoubleType()),
        T.StructField("most_null", T.DoubleType()), T.StructField("empty", T.DoubleType()),
        T.StructField("const", T.StringType()), T.StructField("tie", T.StringType()),
        T.StructField("numtext", T.StringType()), T.StructField("val", T.DoubleType()),
    ])
    return spark.createDataFrame(rows, schema)


CLICKS = [1, 2, 3.5, 3.6, 6, 6.1, 8.5]
CLICK_CODES = [1, 1, 1, 2, 2, 0, 0]

CODES = ["2013J", " 2014B ", "bad", None, "", "2014X"]
CODE_YEARS = [2013, 2014, 2014, 2014, 2014, 2014]
CODE_SEMESTERS = ["J", "B", "d", "e", None, "X"]

# (label, prediction, score) -- a class never predicted (2), tied scores
PREDS3 = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 0), (2, 1), (0, 0), (1, 0), (2, 2), (0, 0)]
PREDS2 = [(0, 0, 0.1), (0, 1, 0.4), (1, 1, 0.35), (1, 1, 0.8), (0, 0, 0.35), (1, 0, 0.35),
          (0, 0, 0.2), (1, 1, 0.9), (0, 1, 0.7), (1, 0, 0.1)]
