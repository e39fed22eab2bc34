
from . import q_access, q_clean, q_edits, q_export, q_history, q_images, q_ingest, q_records, q_schema, q_stream  # noqa: F401
from .registry import REGISTRY, Query, query  # noqa: F401
