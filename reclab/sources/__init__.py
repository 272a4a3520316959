"""Readers, writers and test-data fixtures."""

from reclab.sources.schema import INTERACTIONS, FORMATTED, check_schema
from reclab.sources.io import (append_results, load_model, model_exists, read_interactions,
                               read_results, save_model, write_csv, write_table)
from reclab.sources.fixtures import (events_interactions, interactions, item_side, load_table,
                                     user_side)

__all__ = [
    "INTERACTIONS", "FORMATTED", "check_schema", "append_results", "load_model",
    "model_exists", "read_interactions", "read_results", "save_model", "write_csv",
    "write_table", "events_interactions", "interactions", "item_side", "load_table",
    "user_side",
]
