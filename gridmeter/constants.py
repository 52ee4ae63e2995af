"""Fixed values.

These must stay exactly as they are for results to match the source system's
data and semantics.  They are stated here once, in natural order, and
imported wherever they are used.
"""

# Text markers in the data.
COMPLETE_STATUS = "complete"                          # task status of a finished task
OVERUSE_PREFIX = "Resource overusage for memory"      # error_summary of a memory-overuse failure
PARAMETER_PREFIX = "$eval"                            # memory request given as an expression

# Requirement defaults (documented) and the memory fallback, in GB.
DEFAULT_REQUIREMENTS = {"disk": 10.0, "memory": 2.0, "cpu": 1.0, "gpu": 0.0, "time": 1.0}
FALLBACK_MEMORY = 2.0

# id2num digit rule, base and modulus.
#   code >= 97 -> code - 96;  code >= 65 -> code - 38;  otherwise code + 5
ID_BASE = 62
ID_MODULUS = 10 ** 15

# Units.
BYTES_PER_GIB = 2 ** 30
SECONDS_PER_HOUR = 3600.0

# Requirement key dropped from the document-path output.
DROPPED_REQUIREMENT = "os"
