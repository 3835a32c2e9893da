import os
import tempfile

from tabulark.operators import clean as C
from tabulark.streaming.apply import apply_cleaning, stream_cleaned

from fixtures import dirty


def test_fitted_cleaning_replays_on_a_stream(spark):
    d = dirty(spark).drop("val")
    fitted = C.clean_dataset(d, target="grp", critical=("id", "grp"), outlier_names=("clicks",),
                             outlier_prefixes=())
    src = tempfile.mkdtemp(prefix="tabulark-stream-")
    d.write.mode("overwrite").parquet(os.path.join(src, "batch0"))
    stream = stream_cleaned(spark, os.path.join(src, "batch0"), d.schema, fitted, critical=("id", "grp"))
    q = stream.writeStream.format("memory").queryName("cleaned_stream").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = sorted(tuple(r) for r in spark.sql("SELECT * FROM cleaned_stream").collect())
    want = sorted(tuple(r) for r in apply_cleaning(d, fitted, ("id", "grp")).collect())
    assert got == want and len(got) == 12
