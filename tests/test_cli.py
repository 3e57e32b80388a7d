import pytest
from rows import customer, messages, transaction

from tidemark.plans import silver
from tidemark.spec import ACCOUNTS, CUSTOMERS, TRANSACTIONS
from tidemark.streaming import cli


def test_all_layers_from_files(spark, run_dir, layout):
    for spec, row in (
        (TRANSACTIONS, transaction(1)),
        (CUSTOMERS, customer(1)),
        (ACCOUNTS, {"account_id": "A1"}),
    ):
        messages(spark, [row, None, "{bad"], spec.topic).write.parquet(f"{run_dir}/topics/{spec.name}")
    cli.main(["all", "--root", run_dir, "--topics", f"{run_dir}/topics", "--catch-up"])
    assert spark.read.parquet(layout.bronze("accounts")).count() == 1
    for spec in (TRANSACTIONS, CUSTOMERS, ACCOUNTS):
        rejected = spark.read.parquet(layout.quarantine(spec.name)).collect()
        assert sorted(r.reason for r in rejected) == ["MALFORMED", "TOMBSTONE"]
        kept = spark.read.parquet(layout.bronze(spec.name)).select("_feed_offset").collect()
        assert sorted([r.offset for r in rejected] + [r[0] for r in kept]) == [0, 1, 2]
    assert silver.read_transactions(spark, layout).count() == 1
    assert silver.read_customers(spark, layout).count() == 1


def test_bronze_needs_a_source(run_dir, capsys):
    with pytest.raises(SystemExit):
        cli.parse(["bronze", "--root", run_dir])
    assert "--servers" in capsys.readouterr().err


def test_admission_defaults():
    options = cli.parse(["bronze", "--root", "/lake", "--servers", "kafka:9093"])
    assert (options.max_offsets, options.catch_up) == (None, False)
