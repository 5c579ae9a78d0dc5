"""The steps as separate jobs, as an orchestrator would run them."""

import pytest

from brontide import jobs
from brontide.errors import DataQualityError
from brontide.session import work_dir

CUSTOMER = "/root/testdata/sf0.001/customer.parquet"


def run(spark, *args):
    jobs.run(spark, jobs.parser().parse_args(list(map(str, args))))


def test_steps(spark, capsys):
    base = work_dir(spark, "test-jobs")
    csv, clean, meta, target = (f"{base}/{x}" for x in ("csv", "clean", "meta", "bronze"))
    table = ("--table", "Customer")
    run(spark, "export", *table, "--csv-dir", csv, "--metadata-dir", meta, "--parquet", CUSTOMER,
        "--primary-keys", "c_custkey", "--foreign-key", "c_nationkey=nation.n_nationkey")
    run(spark, "check-csv", *table, "--csv-dir", csv)
    run(spark, "cleanse", *table, "--csv-dir", csv, "--cleansed-dir", clean, "--metadata-dir", meta)
    run(spark, "load", *table, "--cleansed-dir", clean, "--target-base", target)
    run(spark, "validate", *table, "--target-base", target, "--min-rows", 150)
    lines = [x for x in capsys.readouterr().out.splitlines() if x.startswith("[")]
    assert [x.split("]")[0][1:] for x in lines] == [
        "EXPORT_OK", "VALIDATE_CSV_OK", "DQ_OK", "LOAD_OK", "VALIDATE_OK"]
    assert lines[2] == "[DQ_OK] table=Customer source_rows=150 cleansed_rows=150"
    with pytest.raises(DataQualityError):
        run(spark, "validate", *table, "--target-base", target, "--min-rows", 151)


def test_ingest_step(spark, capsys):
    base = work_dir(spark, "test-jobs")
    run(spark, "ingest", "--table", "t", "--csv-dir", f"{base}/a", "--cleansed-dir", f"{base}/b",
        "--metadata-dir", f"{base}/c", "--target-base", f"{base}/d", "--parquet", CUSTOMER)
    assert "[LOAD_OK] table=t rows=150" in capsys.readouterr().out
