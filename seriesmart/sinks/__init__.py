from .partitions import manifest_of, publish_partitions, read_partitions
from .writers import (WriteResult, append, create_table, current_location, export_csv,
                      publish_full_refresh, read_current, register_table, replace_partitions,
                      table_exists, write_bucketed,
                      write_lines, write_observed, write_tsv)

__all__ = ["WriteResult", "append", "create_table", "current_location", "export_csv", "manifest_of",
           "publish_full_refresh", "publish_partitions", "read_current", "read_partitions", "register_table",
           "replace_partitions", "table_exists", "write_bucketed", "write_lines", "write_observed", "write_tsv"]
