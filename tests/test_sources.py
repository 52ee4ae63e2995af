"""The table scan with the declared schemas: byte-string ids, as in the source."""

from pyspark.sql import functions as F

from gridmeter.catalog import round_doubles
from gridmeter.plans.usage_tables import usage_from_tables
from gridmeter.sources.derived import table_views
from gridmeter.sources.tables import read_tables, scan_counts
from tests.conftest import SF_SMALL

ID_COLUMNS = {"task_id", "task_rel_id", "job_id", "task_stat_id"}


def _as_bytes(c):
    # zero-padded so that byte order equals numeric order
    return F.lpad(F.col(c).cast("string"), 12, "0").cast("binary").alias(c)


def test_read_tables_with_byte_ids(spark, scratch):
    views = table_views(spark, SF_SMALL)
    for name, df in views.items():
        df.select(*[_as_bytes(c) if c in ID_COLUMNS else F.col(c) for c in df.columns]) \
          .write.parquet(f"{scratch}/{name}")
    tables = read_tables(spark, scratch)
    counted = scan_counts(tables).where("n_values > 0").collect()
    assert {r["table"]: r["n_rows"] for r in counted} == {n: df.count() for n, df in views.items()}
    # Every declared column is read; those that the files lack have no values.
    assert scan_counts(tables).count() == 53
    assert {(r["table"], r["column_name"]) for r in counted} == {(n, c) for n, df in views.items() for c in df.columns}
    got = round_doubles(usage_from_tables(tables)).withColumn(
        "task_id", F.decode("task_id", "UTF-8").cast("bigint"))
    want = round_doubles(usage_from_tables(views))
    assert got.count() == want.count() == 23
    assert got.exceptAll(want.select(*got.columns)).count() == 0
