"""Memory requests and requirement defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmeter.constants import DEFAULT_REQUIREMENTS, FALLBACK_MEMORY
from gridmeter.functions.json import json_has_key, json_text


def memory_parts(requirements: Column | str, prefix: str) -> dict[str, Column]:
    """(present, value) of the memory requirement of one requirements document.

    `present` is true when the text is non-empty and its object has a `memory`
    key, even one holding null; `value` is the key's text cast to double
    (NULL for JSON null and for text that is not a number).  Computing these
    next to the scan lets the JSON text stay out of later shuffles.
    """
    r = F.col(requirements) if isinstance(requirements, str) else requirements
    present = F.coalesce((F.length(r) > 0) & json_has_key(r, "memory"), F.lit(False))
    value = json_text(r, "memory").try_cast("double")
    return {f"{prefix}_mem_present": present, f"{prefix}_mem": value}


def initial_request(rel_present: Column, rel_value: Column) -> Column:
    """Memory requested by the task type, else the fallback."""
    return F.when(rel_present, rel_value).otherwise(F.lit(FALLBACK_MEMORY))


def final_request(task_present: Column, task_value: Column,
                  rel_present: Column, rel_value: Column) -> Column:
    """The task's own memory request, else its type's, else the fallback.

    A key that is present but null gives NULL: no fallback (a nested CASE, not
    a coalesce).
    """
    return (F.when(task_present, task_value)
             .when(rel_present, rel_value)
             .otherwise(F.lit(FALLBACK_MEMORY)))


def with_default_requirements(df: DataFrame, column: str = "requirements",
                              defaults: dict[str, float] | None = None) -> DataFrame:
    """Add one double column per requirement key, filled from the defaults.

    A key that is missing, null or not a number takes the default value.
    """
    defaults = defaults or DEFAULT_REQUIREMENTS
    return df.withColumns({
        k: F.coalesce(json_text(column, k).try_cast("double"), F.lit(float(v)))
        for k, v in defaults.items()
    })
