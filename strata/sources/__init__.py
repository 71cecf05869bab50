from strata.sources.files import (  # noqa: F401
    list_nonempty_files, path_length, read_csv_recursive, read_delimited, read_delimited_checked, read_table,
)
