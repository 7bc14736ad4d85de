from .buckets import open_buckets, write_buckets
from .readers import read_stations, read_table, read_taxi, read_trips, refused_cells
from .text import parse_centres, parse_name_list
from .writers import cut_lineage, path_exists, replace_partitions, write_table

__all__ = [
    "cut_lineage",
    "open_buckets",
    "parse_centres",
    "parse_name_list",
    "path_exists",
    "read_stations",
    "read_table",
    "read_taxi",
    "read_trips",
    "refused_cells",
    "replace_partitions",
    "write_buckets",
    "write_table",
]
