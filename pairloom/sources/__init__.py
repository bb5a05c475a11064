from pairloom.sources.generators import generate_events, generate_matrix
from pairloom.sources.readers import read_embeddings, read_events, read_mapping, read_matrix, read_row_slice
from pairloom.sources.schema import EVENTS, MAPPING, MATRIX, SchemaError, check_schema
from pairloom.sources.writers import (
    write_bucketed_matrix,
    write_embeddings,
    write_long_embeddings,
    write_matrix,
    write_row_ranges,
)

__all__ = [
    "EVENTS",
    "MAPPING",
    "MATRIX",
    "SchemaError",
    "check_schema",
    "generate_events",
    "generate_matrix",
    "read_embeddings",
    "read_events",
    "read_mapping",
    "read_matrix",
    "read_row_slice",
    "write_bucketed_matrix",
    "write_embeddings",
    "write_long_embeddings",
    "write_matrix",
    "write_row_ranges",
]
