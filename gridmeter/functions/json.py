"""JSON helpers with the NULL readings the queries depend on.

* text at a path: a missing key and a JSON null both give NULL;
* key presence: a key holding JSON null is present;
* booleans: JSON text cast to boolean, unparseable text gives NULL;
* truthiness: the dynamic-language reading of a VARIANT value (missing,
  null, false, 0, "", [] and {} are false; the string "false" is true).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def json_text(doc: Column | str, *path: str) -> Column:
    """Text of the value at `path` (NULL for missing / JSON null / bad JSON)."""
    return F.get_json_object(_c(doc), "$." + ".".join(path))


def json_has_key(doc: Column | str, key: str) -> Column:
    """True when the top-level object has `key`, even if its value is null.

    NULL when the document is not an object (empty text, array, bad JSON).
    """
    return F.array_contains(F.json_object_keys(_c(doc)), F.lit(key))


# Truthiness of a VARIANT value from its JSON text (token type preserved:
# a string keeps its quotes): missing, null, false, 0, "", [] and {} are false.
VARIANT_TRUTHY = ("NOT ({v} IS NULL OR to_json({v}) IN ('null', 'false', '\"\"', '[]', '{{}}') "
                  "OR coalesce(try_cast(to_json({v}) AS DOUBLE) = 0, false))")


def variant_truthy(value: Column | str) -> Column:
    """Truthiness of a VARIANT value (see VARIANT_TRUTHY)."""
    name = value if isinstance(value, str) else None
    if name is not None:
        return F.expr(VARIANT_TRUTHY.format(v=f"`{name}`"))
    j = F.to_json(value)
    return ~(value.isNull() | j.isin("null", "false", '""', "[]", "{}")
             | F.coalesce(j.try_cast("double") == 0, F.lit(False)))
