from textgraph.sources.sinks import read_table, write_folders, write_table, write_tsv
from textgraph.sources.text import (
    read_adjacency,
    read_cells,
    read_folders,
    read_id_list,
    read_key_values,
    read_lines,
    read_tagged,
    read_terms,
    scan_folders,
    terms_of,
)

__all__ = [
    "read_adjacency",
    "read_cells",
    "read_folders",
    "read_id_list",
    "read_key_values",
    "read_lines",
    "read_table",
    "read_tagged",
    "read_terms",
    "scan_folders",
    "terms_of",
    "write_folders",
    "write_table",
    "write_tsv",
]
