"""Sinks: the per-dataset usage table, the harvest ledger, config documents.

All writes are whole-partition replacements (dynamic partition overwrite),
so re-running a harvest after a failure rewrites exactly the datasets it
covers; nothing is appended twice.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEDGER_SCHEMA = T.StructType([
    T.StructField("dataset", T.LongType()),
    T.StructField("n_tasks", T.LongType()),
    T.StructField("n_jobs", T.LongType()),
    T.StructField("n_rows", T.LongType()),
])
# The ledger also holds the run that last wrote a dataset's rows.
STORED_LEDGER = T.StructType([*LEDGER_SCHEMA.fields, T.StructField("run", T.LongType())])

# Registered keys of the open maps: the type a key took in a run.
KEYS_SCHEMA = T.StructType([
    T.StructField("map", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("run", T.LongType()),
])


def write_partitioned(df: DataFrame, path: str, column: str = "dataset") -> None:
    """Replace the partitions of `path` that `df` has rows for; keep the others."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(column).parquet(path))


def write_usage(usage: DataFrame, path: str) -> None:
    """Usage rows, one Parquet partition per dataset, rows of a dataset
    sorted by (dataset, task, job) inside their files."""
    from gridmeter.plans.usage_reports import sort_for_write
    write_partitioned(sort_for_write(usage), path)


def clear_datasets(emptied: DataFrame, tables: dict[str, DataFrame]) -> None:
    """Replace the partitions of datasets that have no rows any more by empty ones
    (a dynamic overwrite only touches partitions that get rows), in every table (path to
    a DataFrame of its columns).  One small write per such dataset; re-harvests to
    nothing are rare."""
    for r in emptied.toLocalIterator():
        for path, rows in tables.items():
            rows.drop("dataset").limit(0).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/dataset={r['dataset']}")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               merge_schema: bool = False) -> DataFrame | None:
    """Read a Parquet table; None when it does not exist yet.

    `merge_schema` reads every file footer to union the column sets (the
    usage columns can differ between datasets); leave it off when only
    counts or common columns are needed.
    """
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Datasets already harvested (a missing ledger is an empty one)."""
    df = read_table(spark, path, STORED_LEDGER)
    return df if df is not None else spark.createDataFrame([], STORED_LEDGER)


def write_ledger(tally: DataFrame, path: str) -> None:
    write_partitioned(tally.select(*[f.name for f in STORED_LEDGER.fields]), path)


def next_run(spark: SparkSession, path: str) -> int:
    """The number of the next run: one more than any in the log of runs at `path`."""
    log = read_table(spark, path, STORED_LEDGER)
    return 1 if log is None else (log.agg(F.max("run")).first()[0] or 0) + 1


def log_run(tally: DataFrame, path: str, run: int) -> DataFrame:
    """Append the tally of a run to the log of runs, which is never rewritten; returns its
    ledger rows as they stand there."""
    names = [f.name for f in LEDGER_SCHEMA.fields]
    tally.select(*names, F.lit(run).cast("bigint").alias("run")).write.mode("append").partitionBy("run").parquet(path)
    return tally.sparkSession.read.schema(STORED_LEDGER).parquet(path).where(F.col("run") == run).select(*names)


class KeyRegistry:
    """Names and types of the keys that became columns, kept beside the usage table.

    A key is 'double' until a value of it is no number; then it is 'string' for good.
    The table is only appended to, a row per new key and per widened one, so a lost
    run leaves it whole.  It holds key names, which are bounded (see operators.pivot).
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        rows = read_table(spark, path, KEYS_SCHEMA)
        self.kinds: dict[str, dict[str, str]] = {}
        self.since: dict[tuple[str, str], int] = {}    # run in which the key came
        self.widened: dict[tuple[str, str], int] = {}  # run in which it became text
        for r in sorted(rows.collect(), key=lambda r: r["run"]) if rows is not None else []:
            self._take(r["map"], r["key"], r["kind"], r["run"])

    def _take(self, name: str, key: str, kind: str, run: int) -> None:
        if (name, key) in self.since and kind == "string":
            self.widened.setdefault((name, key), run)
        self.since.setdefault((name, key), run)
        kinds = self.kinds.setdefault(name, {})
        kinds[key] = "string" if kinds.get(key) == "string" else kind

    def merge(self, found: dict[str, dict[str, str]], run: int) -> dict[str, dict[str, str]]:
        """Register the keys found in a run; returns them with their registered types."""
        new = []
        for name, keys in found.items():
            for key, kind in keys.items():
                before = self.kinds.get(name, {}).get(key)
                if before is None or (before == "double" and kind == "string"):
                    new.append((name, key, kind, run))
                    self._take(name, key, kind, run)
        if new:
            self.spark.createDataFrame(new, KEYS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        return {name: {k: self.kinds[name][k] for k in keys} for name, keys in found.items()}

    def stale(self, ledger: DataFrame) -> DataFrame:
        """Ledger rows of datasets written before a key of theirs became text: their
        files hold it as a number."""
        old = F.lit(False)
        for pair, run in self.widened.items():
            old = old | ((F.col("run") >= self.since[pair]) & (F.col("run") < run))
        return ledger.where(old)


def usage_schema(registry: KeyRegistry) -> T.StructType:
    """Columns of the usage table with the registered keys' types."""
    from gridmeter.constants import DROPPED_REQUIREMENT
    kinds = {"double": T.DoubleType(), "string": T.StringType()}
    fields = [T.StructField("dataset", T.LongType()), T.StructField("task", T.IntegerType()), T.StructField("job", T.IntegerType()),
              T.StructField("time_finished", T.TimestampNTZType())]
    fields += [T.StructField(n, T.StringType()) for n in ("site", "hostname")]
    fields += [T.StructField(n, T.DoubleType()) for n in ("mem_wastage", "input_size", "input_duration", "output_size", "output_duration")]
    for name, suffix in (("requirements", "_req"), ("used", "_used")):
        fields += [T.StructField(k + suffix, kinds[kind]) for k, kind in sorted(registry.kinds.get(name, {}).items())
                   if not (name == "requirements" and k == DROPPED_REQUIREMENT)]
    return T.StructType(fields)


def read_usage(spark: SparkSession, out: str) -> DataFrame | None:
    """The harvested usage table with every column that any run gave it, by the
    registered types: no file's schema is read or merged.  None before the first harvest."""
    return read_table(spark, f"{out}/usage", usage_schema(KeyRegistry(spark, f"{out}/_keys")))


def write_configs(configs: DataFrame, path: str) -> DataFrame:
    """One config document per line; returns the datasets skipped (no config)."""
    configs.where(F.col("config").isNotNull()).select("config").write.mode("overwrite").text(path)
    return configs.where(F.col("config").isNull()).select(
        "dataset_id", F.lit("config_not_found").alias("reason"))
