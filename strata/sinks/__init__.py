from strata.sinks.writers import (  # noqa: F401
    add_partition, append_metrics, create_table, export_table, make_dirs, repair_table,
    publish_staged, list_names, remove_file, touch_empty, write_jdbc,
    write_partitioned, write_report_csv,
)
