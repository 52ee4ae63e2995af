"""Run reports of the table path (task_stat.stat JSON).

Each report is parsed once into a struct with a pruned explicit schema; all
per-report and per-task figures come from that one parse:

* per-report transfer totals are array expressions (filter + aggregate), so
  no explode is needed and a report stays one row;
* every per-task figure is one conditional aggregate of a single
  `groupBy(task_id)`, which Spark runs as partial (map-side) + final
  aggregation: a task with a huge number of reports is pre-reduced in every
  input partition before the shuffle.

NULL readings (they differ on purpose):
  successful report   error value absent or JSON null         (`error IS NULL`)
  not-failed report   error absent, null, or false             (`IS NOT TRUE`)
  good transfer       error is literally false; absent is out  (`<=> false`)
  memory overuse      error_summary starts with the overuse text
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmeter.constants import BYTES_PER_GIB, OVERUSE_PREFIX, SECONDS_PER_HOUR
from gridmeter.functions.ids import MAX_KEY_BYTES, fixed_width_key
from gridmeter.schemas import REPORT


PROBLEMS = ["unparseable_report", "bad_error_value", "bad_resources", "bad_time", "bad_transfer_error", "bad_transfer_value"]


def parse_reports(task_stat: DataFrame, strict: bool = False, counts: Observation | None = None) -> DataFrame:
    """task_stat -> one row per report with typed fields.

    Columns: task_id, task_stat_id, error_text, error_flag, error_summary,
    memory, hours, finished, download, upload (arrays of transfer structs).
    The document is parsed into one struct column first and its fields are
    read in the next projection, so the parse runs once per row (an
    expensive expression used several times is not inlined by Catalyst).
    `strict` raises at run time on a report that `report_problems` would list, from the
    same parse: the key that everything after is grouped by raises.  `counts` gets, when
    the result is computed, how many reports have each of `PROBLEMS`, from the same pass.
    """
    bad = [F.json_object_keys("stat").isNull().alias("bad")] if strict or counts is not None else []
    parsed = task_stat.select("task_id", "task_stat_id", *bad, F.from_json(F.col("stat"), REPORT).alias("_r"))
    r = F.col("_r")
    task_id = F.col("task_id")
    if counts is not None:
        parsed = parsed.withColumn("_why", problem()).observe(
            counts, *[F.coalesce(F.count_if(F.col("_why") == p), F.lit(0)).alias(p) for p in PROBLEMS])
    if strict:
        stop = F.raise_error(F.concat(problem(), F.lit(" in report "), F.col("task_stat_id").cast("string")))
        task_id = F.when(problem().isNull(), task_id).otherwise(stop.cast(task_stat.schema["task_id"].dataType)).alias("task_id")
    return parsed.select(
        task_id, "task_stat_id",
        r["error"].alias("error_text"),
        r["error"].try_cast("boolean").alias("error_flag"),
        r["error_summary"].alias("error_summary"),
        r["resources"]["memory"].try_cast("double").alias("memory"),
        r["resources"]["time"].try_cast("double").alias("hours"),
        r["time"].try_cast("timestamp_ntz").alias("finished"),
        r["task_stats"]["download"].alias("download"),
        r["task_stats"]["upload"].alias("upload"),
    )


def problem() -> Column:
    """Why a parsed report (columns `bad`: no JSON object, `_r`) cannot be read, else null."""
    r = F.col("_r")
    transfers = F.concat(F.coalesce(r["task_stats"]["download"], F.array()), F.coalesce(r["task_stats"]["upload"], F.array()))

    def unread(value: Column, kind: str) -> Column:
        return value.isNotNull() & value.try_cast(kind).isNull()

    bad_error = F.exists(transfers, lambda x: unread(x["error"], "boolean"))
    bad_value = F.exists(transfers, lambda x: x["error"].try_cast("boolean").eqNullSafe(F.lit(False))
                         & (unread(x["size"], "bigint") | unread(x["duration"], "double")))
    return (F.when(F.col("bad"), "unparseable_report")
             .when(unread(r["error"], "boolean"), "bad_error_value")
             .when(unread(r["resources"]["memory"], "double") | unread(r["resources"]["time"], "double"),
                   "bad_resources")
             .when(unread(r["time"], "timestamp_ntz"), "bad_time")
             .when(bad_error, "bad_transfer_error")
             .when(bad_value, "bad_transfer_value"))


# Expressions are written as SQL text: one parse each, instead of one
# JVM round trip per operator when built from Python lambdas.

# A transfer counts when its error is literally false (absent does not).
GOOD_STRICT = "filter({arr}, x -> try_cast(x.error AS BOOLEAN) <=> false)"

# Totals of an array of good transfers: n, exact byte sum, seconds; each sum
# is NULL when every value is NULL, like SQL `sum`.
TOTALS = """named_struct(
  'n', size({arr}),
  'size', aggregate({arr}, CAST(NULL AS DECIMAL(38,0)), (acc, x) ->
            CASE WHEN try_cast(x.size AS BIGINT) IS NULL THEN acc
                 ELSE CAST(coalesce(acc, 0) + CAST(try_cast(x.size AS BIGINT) AS DECIMAL(38,0))
                           AS DECIMAL(38,0)) END),
  'duration', aggregate({arr}, CAST(NULL AS DOUBLE), (acc, x) ->
            CASE WHEN try_cast(x.duration AS DOUBLE) IS NULL THEN acc
                 ELSE coalesce(acc, 0D) + try_cast(x.duration AS DOUBLE) END))"""


def good_transfers(records: str) -> Column:
    """The transfers of one report's array (column `records`) that count on the table path."""
    return F.expr(GOOD_STRICT.format(arr=records))


def transfer_totals(good: str) -> Column:
    """struct(n, size, duration) of the array column named `good`.

    Pass the name of a column holding the filtered array (not the filter
    expression) so the filter is evaluated once.
    """
    return F.expr(TOTALS.format(arr=good))


def has_long_ids(task_stat: DataFrame) -> bool:
    """Whether a byte or text report id is too long for a fixed-width key (one narrow
    aggregate over the id column; other ids need none)."""
    kind = task_stat.schema["task_stat_id"].dataType
    if not isinstance(kind, (T.BinaryType, T.StringType)):
        return False
    longest = task_stat.agg(F.max(F.octet_length("task_stat_id"))).first()[0]
    return (longest or 0) > MAX_KEY_BYTES


def report_figures(reports: DataFrame, long_ids: bool = False) -> DataFrame:
    """Per-report flags and transfer totals (still one row per report), with the report's
    place among its task's as `pick` (`long_ids`: the id itself)."""
    base = ["task_id", "task_stat_id", "pick", "error_text", "error_flag", "memory", "hours", "finished"]
    # Byte and text ids are picked by a fixed-width key that orders alike, where they are short enough.
    kind = reports.schema["task_stat_id"].dataType
    pick = ("task_stat_id" if long_ids or not isinstance(kind, (T.BinaryType, T.StringType)) else
            fixed_width_key("task_stat_id" if isinstance(kind, T.BinaryType) else "CAST(task_stat_id AS BINARY)"))
    staged = reports.withColumn("pick", F.expr(pick)).select(
        *base,
        F.expr(f"coalesce(startswith(error_summary, '{OVERUSE_PREFIX}'), false)").alias("overuse"),
        good_transfers("download").alias("good_down"),
        good_transfers("upload").alias("good_up"),
    )
    return staged.select(*base, "overuse",
                         transfer_totals("good_down").alias("down"),
                         transfer_totals("good_up").alias("up"))


# Per-task states: conditional aggregates of one groupBy(task_id), and how two states of
# a task become one.  The report picked for transfer totals is the smallest report id
# having a good transfer; the pick is split into scalar min_by aggregates over doubles
# (fixed-width buffers), so the rollup stays a hash aggregate.
STATE = {
    "n_ok": ("count(CASE WHEN error_text IS NULL THEN 1 END)", "sum({c})"),
    "rss": ("max(CASE WHEN error_text IS NULL THEN memory END)", "max({c})"),
    "time_finished": ("max(CASE WHEN error_text IS NULL THEN finished END)", "max({c})"),
    "evictions": ("sum(CASE WHEN overuse THEN 1 END)", "sum({c})"),
    "n_ttf": ("count(CASE WHEN overuse THEN hours END)", "sum({c})"),
    "n_run": ("count(CASE WHEN NOT (error_flag <=> true) THEN 1 END)", "sum({c})"),
}
# Sums of doubles that do not depend on the order in which they are added: as decimals of 18
# places for values below 1e10 and of 9 places (all that such doubles have) below 1e20.
# Larger ones, infinities and NaN are added as doubles.
_SUMS = {"ttf": "CASE WHEN overuse THEN hours END", "failed": "CASE WHEN overuse THEN hours * memory END",
         "run": "CASE WHEN NOT (error_flag <=> true) THEN hours END"}
for _name, _value in _SUMS.items():
    STATE[f"{_name}_sum"] = (f"sum(CASE WHEN abs({_value}) < 1e10D THEN CAST({_value} AS DECIMAL(38,18)) END)", "sum({c})")
    STATE[f"{_name}_big"] = (f"sum(CASE WHEN abs({_value}) >= 1e10D AND abs({_value}) < 1e20D "
                             f"THEN CAST({_value} AS DECIMAL(38,9)) END)", "sum({c})")
    STATE[f"{_name}_rest"] = (f"sum(CASE WHEN NOT abs({_value}) < 1e20D THEN {_value} END)", "sum({c})")
for _name, _col in (("input", "down"), ("output", "up")):
    _order = f"CASE WHEN {_col}.n > 0 THEN pick END"
    STATE[f"{_name}_pick"] = (f"min({_order})", "min({c})")
    for _figure, _value in (("size", f"CAST({_col}.size AS DOUBLE) / {float(BYTES_PER_GIB)}D"),
                            ("duration", f"{_col}.duration / {SECONDS_PER_HOUR}D")):
        STATE[f"{_name}_{_figure}"] = (f"min_by({_value}, {_order})", f"min_by({{c}}, {_name}_pick)")


def _total(name: str) -> str:
    more = f"coalesce(CAST({name}_big AS DOUBLE), 0D) + coalesce({name}_rest, 0D)"
    return (f"CASE WHEN {name}_big IS NULL AND {name}_rest IS NULL THEN CAST({name}_sum AS DOUBLE) "
            f"ELSE coalesce(CAST({name}_sum AS DOUBLE), 0D) + {more} END")


# The figures of a state.
FIGURES = {"n_ok": "n_ok", "rss": "rss", "time_finished": "time_finished", "evictions": "evictions",
           "mean_ttf": f"({_total('ttf')}) / n_ttf", "failed_GB_hours": _total("failed"), "n_run": "n_run", "run_time": _total("run")}
for _name in ("input", "output"):
    FIGURES |= {f"has_{_name}": f"{_name}_pick IS NOT NULL", f"{_name}_size": f"{_name}_size",
                f"{_name}_duration": f"{_name}_duration"}


def task_states(task_stat: DataFrame, strict: bool = False, counts: Observation | None = None) -> DataFrame:
    """One row per task: the aggregates of its reports, to be merged with those of other
    reports of it (single aggregate)."""
    f = report_figures(parse_reports(task_stat, strict, counts), has_long_ids(task_stat))
    return f.groupBy("task_id").agg(*[F.expr(e).alias(k) for k, (e, _) in STATE.items()])


def merge_states(states: DataFrame) -> DataFrame:
    """One state per task of several (each report must be in one of them)."""
    kinds = {f.name: f.dataType for f in states.schema.fields}
    merged = states.groupBy("task_id").agg(*[F.expr(m.format(c=k)).alias(k) for k, (_, m) in STATE.items()])
    # A sum of counts or decimals must not change their type, or merged states would not stack.
    return merged.select("task_id", *[F.col(k).cast(kinds[k]).alias(k) for k in STATE])


def state_figures(states: DataFrame) -> DataFrame:
    """The figures of `task_rollup` from one state per task."""
    return states.select("task_id", *[F.expr(e).alias(k) for k, e in FIGURES.items()])


def task_rollup(task_stat: DataFrame, strict: bool = False, counts: Observation | None = None) -> DataFrame:
    """One row per task with every report-derived figure (single aggregate).

    n_ok: successful reports; rss / time_finished: max memory / finish time
    of those; evictions, mean_ttf, failed_GB_hours: count, mean hours and
    sum of memory*hours of overuse reports (NULL when none); run_time: hours
    summed over not-failed reports; input_* / output_*: totals of one report
    per direction (smallest report id with a good transfer), NULL when none.
    Sums do not depend on the order of the reports.  `counts` (see `parse_reports`) gets
    the numbers of reports that cannot be read, from the same pass.
    """
    return state_figures(task_states(task_stat, strict, counts))


# Both transfer arrays of a report as one array of (kind, record).
TAGGED = ("concat(transform(coalesce({down}, array()), x -> named_struct('kind', 'download', 'x', x)), "
          "transform(coalesce({up}, array()), x -> named_struct('kind', 'upload', 'x', x)))")


def tagged_transfers(down: str, up: str) -> Column:
    """`TAGGED` over the download / upload array expressions `down`, `up`."""
    return F.expr(TAGGED.format(down=down, up=up))


def explode_transfers(task_stat: DataFrame) -> DataFrame:
    """One row per transfer record: task_stat_id, task_id, kind, size, duration, error."""
    r = parse_reports(task_stat)
    tagged = tagged_transfers("download", "upload")
    return (r.select("task_stat_id", "task_id", F.explode(tagged).alias("t"))
             .select("task_stat_id", "task_id", F.col("t.kind").alias("kind"),
                     F.col("t.x.size").try_cast("bigint").alias("size"),
                     F.col("t.x.duration").try_cast("double").alias("duration"),
                     F.col("t.x.error").try_cast("boolean").alias("error")))


def report_problems(task_stat: DataFrame) -> DataFrame:
    """Reports whose values cannot be read as the query needs (diagnostics).

    Where a strict SQL cast would stop the whole query, the engine reads
    NULL and lists the report here instead: reason is one of
    'unparseable_report', 'bad_error_value', 'bad_resources', 'bad_time',
    'bad_transfer_error', 'bad_transfer_value' (of a good transfer).  One parse.
    """
    parsed = task_stat.select("task_id", "task_stat_id", F.json_object_keys("stat").isNull().alias("bad"),
                              F.from_json(F.col("stat"), REPORT).alias("_r"))
    # No filter: Spark would push it below the parse and parse for each of its terms again.
    return parsed.select("task_stat_id", "task_id", F.explode(F.array_compact(F.array(problem()))).alias("reason"))


def request_problems(task: DataFrame) -> DataFrame:
    """(task_id, reason): tasks whose own memory request is no number, so that their
    final request reads as NULL."""
    memory = F.get_json_object("requirements", "$.memory")
    return (task.where(memory.isNotNull() & memory.try_cast("double").isNull())
            .select("task_id", F.lit("bad_memory_request").alias("reason")))
