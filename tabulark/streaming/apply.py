"""Apply fitted cleaning parameters to a stream of new activity rows.

The reference has no stream processing. Fitted steps, however, are plain
parameters turned into column expressions, so the same cleaning can score rows
arriving through Structured Streaming: C5 row drop, C6/C7 imputation, C11-C13
outlier treatment and C16 infinity replacement are all stateless per row. No
new operator is introduced here; fits stay batch jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import clean as C


def apply_cleaning(df: DataFrame, fitted: C.CleanResult, critical=C.CRITICAL_COLUMNS) -> DataFrame:
    """Replay a batch ``clean_dataset`` fit on any frame (batch or streaming).

    Dropped columns are dropped, critical nulls removed, then the fitted
    imputation, outlier and infinity parameters applied. Deduplication is
    not replayed (it would need state across the whole stream)."""
    keep = [c for c in fitted.df.columns if c in df.columns]
    out = df.select(*keep)
    out = C.drop_missing_critical(out, critical)
    out = C.apply_impute(out, fitted.impute)
    out = C.apply_outliers(out, fitted.outliers)
    return C.apply_replace_infinite(out, fitted.infinite_medians)


def stream_cleaned(spark: SparkSession, path: str, schema, fitted: C.CleanResult,
                   critical=C.CRITICAL_COLUMNS, fmt: str = "parquet") -> DataFrame:
    """A streaming frame of cleaned rows read from files arriving under ``path``."""
    src = spark.readStream.schema(schema).format(fmt).load(path)
    return apply_cleaning(src, fitted, critical)
