"""Report documents of the document path: `{stat_id: {stats: {...}}}` per task.

A task's reports arrive together in one document, in document order, so all
per-task figures are array expressions over that one row (no shuffle):

* final report: among reports carrying resources, the greatest `time`
  (text order), the first in document order on a tie;
* memory waste: sum of memory*time over overuse reports with resources
  (0.0 when none), accumulated in document order;
* site / hostname: of the last report, even when null;
* transfer totals per direction: of the last report without error_summary
  whose good list is non-empty; a transfer is good unless its error is
  truthy, so a missing error counts (unlike the table path).  `task_stats`
  may be an object or a string holding JSON: both are read as text and
  parsed again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmeter.constants import BYTES_PER_GIB, OVERUSE_PREFIX, SECONDS_PER_HOUR
from gridmeter.functions.json import VARIANT_TRUTHY, variant_truthy
from gridmeter.operators.reports import tagged_transfers
from gridmeter.schemas import REPORT_DOC, TASK_STATS_DOC
from gridmeter.sources.landed import newest

# Report array: (ord, stat_id, s) in document order.
REPORTS = (f"transform(map_entries(from_json(doc, '{REPORT_DOC}')), "
           "(e, i) -> named_struct('ord', i, 'stat_id', e.key, 's', e.value.stats))")

TRUTHY = VARIANT_TRUTHY.replace("{v}", "{x}")


def _overuse(x: str) -> str:
    return f"coalesce(startswith({x}.s.error_summary, '{OVERUSE_PREFIX}'), false)"


def _totals(picked: str, prefix: str) -> dict[str, F.Column]:
    # Sizes may be written as JSON floats; six places hold them exactly.
    size = (f"aggregate({picked}, CAST(0 AS DECIMAL(38,6)), "
            "(a, f) -> CAST(a + coalesce(try_cast(f.size AS DECIMAL(38,6)), 0) AS DECIMAL(38,6)))")
    dur = (f"aggregate({picked}, CAST(0 AS DOUBLE), "
           "(a, f) -> a + coalesce(try_cast(f.duration AS DOUBLE), CAST(0 AS DOUBLE)))")
    return {f"{prefix}_size": F.expr(f"CAST({size} AS DOUBLE) / {float(BYTES_PER_GIB)}D"),
            f"{prefix}_duration": F.expr(f"{dur} / {SECONDS_PER_HOUR}D")}


# Per report: task_stats parsed once (object or JSON string alike), and only
# for reports that can give transfer totals (no error_summary); then the good
# transfers of each direction.
_PARSED = (f"transform(reports, x -> named_struct('ord', x.ord, "
           f"'elig', x.s.error_summary IS NULL, "
           "'has_ts', x.s.task_stats IS NOT NULL, "
           f"'ts', CASE WHEN x.s.error_summary IS NULL "
           f"THEN from_json(x.s.task_stats, '{TASK_STATS_DOC}') END))")
_GOOD = ("transform(parsed, y -> named_struct('elig', y.elig, "
         "'down', filter(y.ts.download, f -> NOT ({t})), "
         "'up', filter(y.ts.upload, f -> NOT ({t}))))").format(t=TRUTHY.format(x="f.error"))
_UNREADABLE = ("exists(parsed, y -> y.elig AND (NOT y.has_ts OR exists("
               "concat(coalesce(y.ts.download, array()), coalesce(y.ts.upload, array())), "
               "f -> NOT ({t}) AND (try_cast(f.size AS DECIMAL(38,6)) IS NULL "
               "OR try_cast(f.duration AS DOUBLE) IS NULL))))"
               ).format(t=TRUTHY.format(x="f.error"))
# Flaws that only strict mode reads (else these columns are pruned): task_stats that
# is no JSON object, overuse resources that are no numbers.
_FLAWED = ("exists(reports, x -> x.s.error_summary IS NULL AND x.s.task_stats IS NOT NULL "
           "AND json_object_keys(x.s.task_stats) IS NULL)")
_WASTE_UNREADABLE = (f"exists(reports, x -> {_overuse('x')} AND x.s.resources IS NOT NULL AND "
                     "(try_cast(x.s.resources['memory'] AS DOUBLE) IS NULL "
                     "OR try_cast(x.s.resources['time'] AS DOUBLE) IS NULL))")


def task_figures(reports: DataFrame, split_above: int | None = None) -> DataFrame:
    """Per task (one input row each): final report figures, waste, site, transfers.

    Output: dataset_id, task_id, n_reports, unreadable, time_finished, used
    (map of the final report's resources), mem_wastage, site, hostname,
    input_size, input_duration, output_size, output_duration.

    Documents of more than `split_above` bytes are not computed in their row but split
    into their reports, which many tasks work on (see `split_figures`); that reads the
    landing a second time for them.
    """
    if split_above is None:
        # Of a task's documents the newest counts: chosen among figures, so no document is shuffled.
        return newest(document_figures(reports).drop("final_time"), "dataset_id", "task_id")
    long = F.coalesce(F.octet_length("doc") > split_above, F.lit(False))
    whole = document_figures(reports.where(~long)).drop("final_time")
    # Of a task's documents, short and long, the newest counts.
    return newest(whole.unionByName(split_figures(reports.where(long))), "dataset_id", "task_id")


def split_figures(reports: DataFrame) -> DataFrame:
    """The figures of `document_figures` for very long documents.

    The task that reads a document only cuts it into its reports (a map of JSON texts);
    these are dealt out by (task, position), each is computed as a document of its own,
    and a task's figures are merged by position: the final report by its time, waste in
    document order, the rest from the last report that has it.
    """
    order = ["landed"] if "landed" in reports.columns else []
    keys = ["dataset_id", "task_id", *order]
    # Cut in a projection of its own, so that a document does not travel with each of its reports.
    cut = reports.select(*keys, F.json_object_keys("doc").isNull().alias("none"), F.col("doc").isNotNull().alias("there"),
                         F.from_json("doc", "MAP<STRING, STRING>").alias("m"))
    entries = cut.select(*keys, "none", "there", F.posexplode_outer("m").alias("ord", "stat_id", "entry")).select(
        *keys, "none", (F.col("none") & F.col("there")).alias("unread"), "ord",
        F.when(F.col("ord").isNotNull(), F.concat(F.lit('{"r":'), F.coalesce("entry", F.lit("null")), F.lit("}"))).alias("doc"))
    one = document_figures(entries.repartition("dataset_id", "task_id", "ord"), "ord", "none", "unread")

    def last(columns: list[str], there: Column) -> Column:
        return F.max_by(F.struct(*columns), F.when(there, F.col("ord")))

    inputs, outputs = ["input_size", "input_duration"], ["output_size", "output_duration"]
    merged = one.groupBy(*keys).agg(
        F.max("none").alias("none"), F.count("ord").cast("int").alias("n"),
        F.max(F.col("unreadable") | F.col("unread")).alias("unreadable"),
        F.max_by(F.struct("time_finished", "used"), F.when(F.col("used").isNotNull(), F.struct("final_time", -F.col("ord")))).alias("f"),
        # At most a number for each report of one document.
        F.sort_array(F.collect_list(F.struct("ord", "mem_wastage"))).alias("w"),
        last(["site", "hostname"], F.col("ord").isNotNull()).alias("l"),
        last(inputs, F.col("input_size").isNotNull()).alias("i"), last(outputs, F.col("output_size").isNotNull()).alias("o"))
    waste = F.aggregate("w", F.lit(0.0), lambda a, x: a + F.coalesce(x["mem_wastage"], F.lit(0.0)))
    return merged.select(
        *keys, F.when(~F.col("none"), F.col("n")).alias("n_reports"), "unreadable", "f.time_finished", "f.used",
        F.when(~F.col("none"), waste).alias("mem_wastage"),
        "l.site", "l.hostname", *[f"i.{c}" for c in inputs], *[f"o.{c}" for c in outputs])


def document_figures(reports: DataFrame, *keep: str) -> DataFrame:
    """`task_figures` of every document row by itself, with the landing order where there is one,
    the columns `keep`, and the text of the final report's time (`final_time`).

    Built as a few projections, each computing an expensive array once
    (the parse of the document, of each task_stats, the good lists).
    """
    keys = ["dataset_id", "task_id", *(["landed"] if "landed" in reports.columns else []), *keep]
    r = reports.select(*keys, F.expr(REPORTS).alias("reports"),
                       (F.col("doc").isNotNull() & F.json_object_keys("doc").isNull()).alias("bad_doc"))
    best = ("array_max(transform(filter(reports, x -> x.s.resources IS NOT NULL), "
            "x -> named_struct('t', x.s.time, 'o', -x.ord)))")
    waste = (f"aggregate(filter(reports, x -> {_overuse('x')} AND x.s.resources IS NOT NULL), "
             "CAST(0 AS DOUBLE), (a, x) -> a + coalesce(try_cast(x.s.resources['memory'] AS DOUBLE)"
             " * try_cast(x.s.resources['time'] AS DOUBLE), CAST(0 AS DOUBLE)))")
    r = r.select(
        *keys,
        F.expr("size(reports)").alias("n_reports"),
        F.expr(f"try_element_at(reports, 1 - {best}.o)").alias("final"),
        F.expr(waste).alias("mem_wastage"),
        F.expr("try_element_at(reports, -1).s").alias("last"),
        (F.col("bad_doc") | F.coalesce(F.expr(_WASTE_UNREADABLE), F.lit(False))
         | F.coalesce(F.expr(_FLAWED), F.lit(False))).alias("bad"),
        F.expr(_PARSED).alias("parsed"))
    r = r.select(*keys, "n_reports", "final", "mem_wastage", "last",
                 (F.col("bad") | F.coalesce(F.expr(_UNREADABLE), F.lit(False))).alias("unreadable"),
                 F.expr(_GOOD).alias("good"))
    r = r.select(*keys, "n_reports", "final", "mem_wastage", "last", "unreadable",
                 F.expr("try_element_at(filter(good, x -> x.elig AND size(x.down) > 0), -1).down")
                 .alias("down"),
                 F.expr("try_element_at(filter(good, x -> x.elig AND size(x.up) > 0), -1).up")
                 .alias("up"))
    return r.select(
        *keys, "n_reports", "unreadable",
        F.expr("final.s.time").alias("final_time"),
        F.expr("try_cast(final.s.time AS TIMESTAMP_NTZ)").alias("time_finished"),
        F.expr("final.s.resources").alias("used"),
        "mem_wastage",
        F.col("last.site").alias("site"),
        F.col("last.hostname").alias("hostname"),
        *[c.alias(k) for k, c in _totals("down", "input").items()],
        *[c.alias(k) for k, c in _totals("up", "output").items()],
    )


# The resources of the final report alone, from a parse of nothing else.
_USED = ("array_max(transform(map_entries(from_json(doc, 'MAP<STRING, STRUCT<stats: STRUCT<time: STRING, "
         "resources: MAP<STRING, STRING>>>>')), (e, i) -> CASE WHEN e.value.stats.resources IS NOT NULL THEN "
         "named_struct('t', e.value.stats.time, 'o', -i, 'r', map_entries(e.value.stats.resources)) END)).r")


def used_resources(reports: DataFrame) -> DataFrame:
    """The `used` map of every landed report document, by a narrow parse (key discovery)."""
    return reports.select(F.map_from_entries(F.expr(_USED)).alias("used"))


def explode_reports(reports: DataFrame) -> DataFrame:
    """One row per report with its document position; a task without
    reports keeps one row with NULLs (posexplode_outer)."""
    return reports.select(
        "dataset_id", "task_id",
        F.posexplode_outer(F.from_json("doc", REPORT_DOC)).alias("ord", "stat_id", "v")
    ).select("dataset_id", "task_id", "ord", "stat_id", F.col("v.stats").alias("stats"))


def explode_transfers(reports: DataFrame) -> DataFrame:
    """Transfers of every report, with task_stats decoded from either encoding."""
    e = explode_reports(reports).where(F.col("stats").isNotNull())
    e = e.select("*", F.from_json(F.col("stats.task_stats"), TASK_STATS_DOC).alias("_ts"))
    tagged = tagged_transfers("_ts.download", "_ts.upload")
    return (e.select("task_id", "ord", "stat_id",
                     F.col("stats.error_summary").alias("error_summary"),
                     F.explode(tagged).alias("t"))
             .select("task_id", "ord", "stat_id", "error_summary", F.col("t.kind").alias("kind"),
                     F.col("t.x.size").try_cast("bigint").alias("size"),
                     F.col("t.x.duration").try_cast("double").alias("duration"),
                     F.col("t.x.error").alias("error")))


def report_diagnostics(reports: DataFrame) -> DataFrame:
    """Reports the document path cannot use, with the reason.

    overuse_without_resources: an overuse report without resources (it adds
      nothing to the waste);
    overuse_bad_resources: an overuse report whose memory or time is missing
      or no number;
    unreadable_document: the task's document is not a JSON object;
    unreadable_task_stats: task_stats is not a JSON object;
    missing_task_stats: a report without error_summary and without
      task_stats (nothing to read transfers from);
    transfer_missing_fields: a good transfer without size or duration;
    transfer_bad_value: a good transfer whose size or duration is no number.
    """
    unread = reports.where(F.col("doc").isNotNull() & F.json_object_keys("doc").isNull()).select(
        "dataset_id", "task_id", F.lit(None).cast("string").alias("stat_id"), F.lit(None).cast("int").alias("ord"),
        F.lit("unreadable_document").alias("reason"))
    e = explode_reports(reports).where(F.col("stats").isNotNull())
    e = e.select("*", F.from_json(F.col("stats.task_stats"), TASK_STATS_DOC).alias("_ts"))
    s, ts = F.col("stats"), F.col("_ts")
    missing = {k: s["resources"][k].try_cast("double").isNull() for k in ("memory", "time")}
    overuse = F.coalesce(s["error_summary"].startswith(OVERUSE_PREFIX), F.lit(False))
    bad_fields = F.exists(
        F.concat(F.coalesce(ts["download"], F.array()), F.coalesce(ts["upload"], F.array())),
        lambda f: ~variant_truthy(f["error"]) & (f["size"].isNull() | f["duration"].isNull()))
    bad_values = F.exists(
        F.concat(F.coalesce(ts["download"], F.array()), F.coalesce(ts["upload"], F.array())),
        lambda f: ~variant_truthy(f["error"]) & (f["size"].try_cast("decimal(38,6)").isNull()
                                                 | f["duration"].try_cast("double").isNull()))
    reason = (F.when(overuse & s["resources"].isNull(), "overuse_without_resources")
               .when(overuse & (missing["memory"] | missing["time"]), "overuse_bad_resources")
               .when(s["error_summary"].isNull() & s["task_stats"].isNull(), "missing_task_stats")
               .when(s["error_summary"].isNull() & F.json_object_keys(s["task_stats"]).isNull(),
                     "unreadable_task_stats")
               .when(s["error_summary"].isNull() & bad_fields, "transfer_missing_fields")
               .when(s["error_summary"].isNull() & bad_values, "transfer_bad_value"))
    # No filter: Spark would push it below the parse and parse for each of its terms again.
    return (e.select("dataset_id", "task_id", "stat_id", "ord", F.explode(F.array_compact(F.array(reason))).alias("reason"))
            .unionByName(unread))
