from .chunks import order_chunk
from .hashing import canonical_json, content_hash
from .placed import number_rows
from .types import is_temporal, to_event_time, to_rank_number

__all__ = [
    "canonical_json",
    "content_hash",
    "is_temporal",
    "number_rows",
    "order_chunk",
    "to_event_time",
    "to_rank_number",
]
