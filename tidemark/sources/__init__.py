from tidemark.sources.layout import (
    analyze, cluster_profile, cluster_summary, clustering_columns, file_spans,
    partition_columns, stored_statistics, table_detail,
)
from tidemark.sources.scratch import materialise, scratch_folder
from tidemark.sources.tables import (
    DEPARTMENT, EMPLOYEE, TableSpec, conform, read_table, row_range, value_rows,
)
from tidemark.sources.writers import (
    append_rows, by_partition, by_range, compact_partitions, create_or_replace,
    publish_clustered, write_clustered, write_curved, write_partitioned,
)

__all__ = [
    "DEPARTMENT", "EMPLOYEE", "TableSpec", "analyze", "append_rows", "by_partition",
    "by_range", "cluster_profile", "cluster_summary", "clustering_columns", "compact_partitions", "conform",
    "create_or_replace", "file_spans", "materialise", "partition_columns", "publish_clustered",
    "read_table", "row_range", "scratch_folder", "stored_statistics", "table_detail", "value_rows",
    "write_clustered", "write_curved", "write_partitioned",
]
