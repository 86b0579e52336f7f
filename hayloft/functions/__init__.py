"""Column expressions (all JVM-side built-ins, no UDFs)."""

from hayloft.functions.time import (  # noqa: F401
    OPEN_END,
    epoch_seconds,
    time_bucket,
    year_month,
)
from hayloft.functions.names import repair_mojibake  # noqa: F401
from hayloft.functions.measures import (  # noqa: F401
    clamp_non_negative,
    count_equal,
    loading_accuracy,
    surrogate_key,
)
