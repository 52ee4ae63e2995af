"""Incremental harvest of landed documents into a per-dataset Parquet table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Work lists up to this many datasets become a literal filter on the landed
# partition column, which prunes files at planning; longer ones a semi-join.
MAX_LITERAL_IDS = 1_000


def dataset_tally(datasets: DataFrame, rows: DataFrame, jobs: DataFrame) -> DataFrame:
    """(dataset, n_tasks, n_jobs, n_rows) for every listed dataset.

    `rows` are per-task rows (`task_rows`: dataset, has_job), `jobs` the job
    listing.  Two small aggregates (partial aggregation before each shuffle)
    joined on the dataset; datasets with nothing get zeros.  No report is parsed.
    """
    per_ds = rows.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_tasks"),
                                         F.count(F.when(F.col("has_job"), 1)).alias("n_rows"))
    nj = jobs.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("n_jobs"))
    return (datasets.select("dataset", "dataset_id").join(per_ds, "dataset", "left").join(nj, "dataset_id", "left")
            .select("dataset", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
                                 for c in ("n_tasks", "n_jobs", "n_rows")]))


def of_datasets(raw: DataFrame, ids: DataFrame, literal: list[str] | None) -> DataFrame:
    """The rows of the datasets in `ids`; landed records are filtered on the landed
    partition column before any document is parsed."""
    if literal is not None:
        return raw.where(F.col("dataset_id").isin(literal))
    return raw.join(ids, "dataset_id", "left_semi")


def _wanted(spark, include, done: DataFrame, rows: DataFrame) -> DataFrame:
    """Of `rows` (dataset, dataset_id, ...) those that a harvest is to do: the datasets in
    `include` (numbers, or a DataFrame of ids), without it those not in the ledger."""
    key = F.col("dataset").cast("string")
    if include is None:
        return rows.join(done.select(F.col("dataset").cast("string").alias("_done")), key == F.col("_done"), "left_anti")
    if isinstance(include, DataFrame):
        return rows.join(include.select("dataset_id").distinct(), "dataset_id", "left_semi")
    return rows.where(key.isin([str(v) for v in include]))


def listed_datasets(spark, landing: str, index: DataFrame | None, include, done: DataFrame, strict: bool = False) -> DataFrame:
    """(dataset, dataset_id) of the work list, from the dataset listings that name them
    (without an index: from all listings)."""
    from gridmeter.sources import file_index, landed
    if index is None:
        raw = landed.read_landed(spark, landing, "datasets")
    else:
        # All listings of an id that any listing gives a wanted number: the newest decides.
        ids = _wanted(spark, include, done, index.where("kind = 'datasets'"))
        raw = file_index.named(spark, landing, "datasets", file_index.files_of(index, "datasets", ids, strict))
    raw = landed.checked(raw, "datasets") if strict else raw
    return _wanted(spark, include, done, landed.scan_datasets(raw)).select("dataset", "dataset_id")


def landed_inputs(spark, landing: str, index: DataFrame | None, ids: DataFrame, literal: list[str] | None,
                  strict: bool = False) -> dict[str, DataFrame]:
    """The scanned `tasks`, `jobs` and `reports` of the datasets in `ids`.

    With an index only the files that hold them are opened, and in these other datasets'
    records are dropped before their documents are parsed; task documents that name
    another dataset than their record are in files of their own scan, which parses
    first.  Without an index everything is opened.
    """
    from gridmeter.sources import file_index, landed

    def read(kind: str, files: DataFrame | None = None) -> DataFrame:
        raw = landed.read_landed(spark, landing, kind) if files is None else file_index.named(spark, landing, kind, files)
        return landed.checked(raw, kind) if strict else raw

    def of(rows: DataFrame) -> DataFrame:
        return of_datasets(rows, ids, literal)

    if index is None:
        tasks = landed.scan_tasks(read("tasks"), of=of)
        return {"tasks": tasks, "jobs": landed.scan_jobs(of(read("jobs"))), "reports": landed.scan_reports(of(read("reports")))}
    files = {k: file_index.files_of(index, k, ids, strict) for k in ("tasks", "jobs", "reports")}
    own = read("tasks", files["tasks"].where("NOT foreign"))
    both = of(own).unionByName(read("tasks", files["tasks"].where("foreign")))
    return {"tasks": landed.scan_tasks(both, of=of), "jobs": landed.scan_jobs(of(read("jobs", files["jobs"]))),
            "reports": landed.scan_reports(of(read("reports", files["reports"])))}


def harvest(spark, landing: str, out: str, include=None, *, req_keys=None, used_keys=None,
            strict: bool = False, split_above: int | None = None) -> DataFrame:
    """Harvest landed documents of the datasets not yet in the ledger.

    `include` (dataset numbers, or a DataFrame with a `dataset_id` column)
    selects exactly those datasets, re-harvesting them even when already
    present.  Of documents that landed again the newest counts.  The ledger, not the
    usage directory, decides what is done, so a dataset with no rows counts as
    harvested.  A re-harvest replaces a dataset's rows, also by none.  `strict` raises on
    records that cannot be read; report documents of more than `split_above` bytes are
    spread over tasks report by report.  One harvest of an `out` runs at a time.

    Under `out`: `usage` (partition per dataset; read it with `sinks.read_usage`), `_rows`
    (the per-task rows behind it, open maps whole, so that its columns never change
    type), `_keys` (names and types of the keys that became columns), `_files` (which
    landed file holds which datasets), `_ledger` (a row per dataset) and `_runs` (a row
    per dataset and run).  A key that gets its first text value becomes a text column;
    the datasets written before with it as a number are written again from `_rows`.

    Returns the ledger rows of this run, as they stand in `_runs`.
    """
    from gridmeter.operators.pivot import discover_keys_of
    from gridmeter.plans.usage_reports import finish_usage, task_rows
    from gridmeter.session import drop_path, materialize
    from gridmeter.sources import file_index, sinks

    run = sinks.next_run(spark, f"{out}/_runs")
    ledger = sinks.read_ledger(spark, f"{out}/_ledger")
    # The first harvest of everything needs every file anyway.
    index = None if include is None and run == 1 else file_index.refresh(spark, landing, f"{out}/_files")
    scratch = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        table, path = materialize(df, f"harvest-{name}", with_path=True)
        scratch.append(path)
        return table

    try:
        work = keep(listed_datasets(spark, landing, index, include, ledger, strict), "work")
        few = work.select("dataset_id").limit(MAX_LITERAL_IDS + 1).collect()
        literal = [r["dataset_id"] for r in few] if len(few) <= MAX_LITERAL_IDS else None
        found = landed_inputs(spark, landing, index, work.select("dataset_id"), literal, strict)
        # One table of per-task rows feeds the usage output, the keys and the tally:
        # listings and documents are parsed once.
        rows = keep(task_rows(work, found["jobs"], found["tasks"], found["reports"], strict=strict,
                              split_above=split_above), "rows")
        registry = sinks.KeyRegistry(spark, f"{out}/_keys")
        maps = discover_keys_of({c: rows.where("has_job").select(c) for c in ("requirements", "used")})
        given = {"requirements": req_keys, "used": used_keys}
        maps = {c: keys if given[c] is None else {k: (given[c][k] if isinstance(given[c], dict) else keys.get(k, "double"))
                                                  for k in given[c]} for c, keys in maps.items()}
        maps = registry.merge(maps, run)
        old = registry.stale(ledger.join(work, "dataset", "left_anti"))
        tally = keep(dataset_tally(work, rows, found["jobs"]).select("*", F.lit(False).alias("old"))
                     .unionByName(old.drop("run").select("*", F.lit(True).alias("old")))
                     .withColumn("run", F.lit(run).cast("bigint")), "tally")
        sinks.write_partitioned(rows.hint("rebalance", "dataset"), f"{out}/_rows")
        usage = finish_usage(rows, req_keys=maps["requirements"], used_keys=maps["used"])
        again = tally.where("old AND n_rows > 0").select("dataset")
        if not again.isEmpty():
            # All registered keys, as the datasets written before may have any of them.
            before = sinks.read_table(spark, f"{out}/_rows", rows.schema).join(again, "dataset", "left_semi")
            kinds = {c: {k: v for k, v in registry.kinds.get(c, {}).items()} for c in ("requirements", "used")}
            sinks.write_usage(finish_usage(before, req_keys=kinds["requirements"], used_keys=kinds["used"]), f"{out}/usage")
        sinks.write_usage(usage, f"{out}/usage")
        emptied = (tally.where("n_rows = 0 AND NOT old").select("dataset")
                   .join(ledger.where("n_rows > 0"), "dataset", "left_semi"))
        sinks.clear_datasets(emptied, {f"{out}/usage": usage, f"{out}/_rows": rows})
        done = sinks.log_run(tally.where("NOT old"), f"{out}/_runs", run)
        sinks.write_ledger(tally, f"{out}/_ledger")
        return done
    finally:
        for path in scratch:
            drop_path(spark, path)


def export_configs(spark, landing: str, out: str) -> DataFrame:
    """C4: write every dataset's config document as one line; return the
    datasets without a config (diagnostics)."""
    from gridmeter.sources import landed, sinks
    configs = landed.scan_configs(landed.read_landed(spark, landing, "configs"))
    return sinks.write_configs(configs, out)
