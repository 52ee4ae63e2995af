"""Column functions: built-in Spark expressions only, no Python UDFs."""

from gridmeter.functions.ids import ID2NUM_SQL, id2num, register_sql_functions
from gridmeter.functions.json import json_has_key, json_text, variant_truthy
from gridmeter.functions.requests import (DEFAULT_REQUIREMENTS, final_request, initial_request,
                                          memory_parts, with_default_requirements)
from gridmeter.functions.text import decode_bytes, name_above, name_not_equal

__all__ = [
    "ID2NUM_SQL", "id2num", "register_sql_functions", "json_has_key", "json_text",
    "variant_truthy", "DEFAULT_REQUIREMENTS", "final_request", "initial_request",
    "memory_parts", "with_default_requirements", "decode_bytes", "name_above", "name_not_equal",
]
