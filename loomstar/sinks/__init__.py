from loomstar.sinks.clustering import where_equal, write_clustered
from loomstar.sinks.digests import files_with, insert_if_absent_by_digest
from loomstar.sinks.tables import (
    append, exists, in_buckets, insert_by_name, insert_by_position, insert_if_absent, layout, load_dimension, once,
    overwrite, overwrite_partitions, packing, partition_path, reset_tables, save_bucketed, upsert, write_csv,
    write_table,
)
from loomstar.sinks.versions import compact, read_versions, upsert_versions

__all__ = [
    "append", "compact", "exists", "files_with", "in_buckets", "insert_by_name", "insert_by_position", "insert_if_absent", "insert_if_absent_by_digest", "layout",
    "load_dimension", "once", "overwrite", "overwrite_partitions", "packing", "partition_path", "read_versions", "reset_tables",
    "save_bucketed", "upsert", "upsert_versions", "where_equal", "write_clustered", "write_csv", "write_table",
]
