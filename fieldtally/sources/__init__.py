from fieldtally.sources.delimited import (
    CUSTOMERS_SCHEMA,
    EDGES_SCHEMA,
    ORDERS_SCHEMA,
    POSITIONS_SCHEMA,
    is_table_file,
    read_edge_list,
    read_pipe_table,
    read_positions,
    read_tagged_tables,
    with_event_time,
)
from fieldtally.sources.streams import stream_positions

__all__ = [
    "CUSTOMERS_SCHEMA",
    "EDGES_SCHEMA",
    "ORDERS_SCHEMA",
    "POSITIONS_SCHEMA",
    "is_table_file",
    "read_edge_list",
    "read_pipe_table",
    "read_positions",
    "read_tagged_tables",
    "stream_positions",
    "with_event_time",
]
