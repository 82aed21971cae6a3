import os
import tempfile

from cohortlens.operators.clean import clean_transactions
from cohortlens.streaming import read_raw_stream, stream_audit_counts, stream_clean_rows
from tests.fixtures import CLEANING_ROWS


def _write_csv(rows, path):
    header = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
    with open(path, "w") as fh:
        fh.write(header)
        for r in rows:
            fh.write(",".join("" if v is None else str(v) for v in r) + "\n")


def test_stream_matches_batch_rules(spark):
    d = tempfile.mkdtemp(prefix="cohortlens-stream-")
    src = os.path.join(d, "in")
    os.makedirs(src)
    _write_csv(CLEANING_ROWS[:6], os.path.join(src, "part1.csv"))
    _write_csv(CLEANING_ROWS[6:], os.path.join(src, "part2.csv"))

    raw = read_raw_stream(spark, src, max_files_per_trigger=1)
    out = os.path.join(d, "clean")
    q1 = (
        stream_clean_rows(raw)
        .writeStream.format("parquet")
        .option("checkpointLocation", os.path.join(d, "ck1"))
        .start(out)
    )
    q2 = (
        stream_audit_counts(raw)
        .writeStream.format("memory")
        .queryName("cohortlens_audit")
        .outputMode("complete")
        .option("checkpointLocation", os.path.join(d, "ck2"))
        .start()
    )
    try:
        q1.processAllAvailable()
        q2.processAllAvailable()
    finally:
        q1.stop()
        q2.stop()

    written = spark.read.parquet(out)
    assert written.count() == 4  # one duplicate still present before the batch stage
    assert clean_transactions(written.drop("Revenue")).count() == 3
    counts = {r.rule: r.rows for r in spark.sql("SELECT * FROM cohortlens_audit").collect()}
    assert counts["kept"] == 4
    assert sum(counts.values()) == len(CLEANING_ROWS)
