"""The canonical dataset, written once for jobs that read it several times."""

from opsloom.sources import views


def test_staged_dataset_is_written_once_and_equal(spark, sf_dir):
    plain = views.canonical_dataset(spark, sf_dir, anomalies=True)
    staged = views.canonical_dataset(spark, sf_dir, anomalies=True, stage=True)
    events = set(spark.read.parquet(f"{sf_dir}/events.parquet").inputFiles())
    for name, table in staged.items():
        assert not set(table.inputFiles()) & events
        assert table.schema == plain[name].schema or table.dtypes == plain[name].dtypes
        assert table.exceptAll(plain[name]).isEmpty() and plain[name].exceptAll(table).isEmpty()
