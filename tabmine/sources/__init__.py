from tabmine.sources.tables import (  # noqa: F401
    read_delimited,
    read_delimited_as_strings,
    read_delimited_exact,
    read_lookup_file,
    read_model_ready,
    read_table,
    with_missing_token,
)
from tabmine.sources.sinks import document, json_safe, read_report, write_document, write_report, write_table  # noqa: F401
