"""Sources and sinks."""

from hayloft.sources.calendar import calendar, calendar_of  # noqa: F401
from hayloft.sources.files import (  # noqa: F401
    load_inputs,
    read_csv_messages,
    read_table,
    write_table,
)
