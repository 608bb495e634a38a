from tickloom.sources.events import frames_from_events
from tickloom.sources.raw import (
    file_frames, file_history, kafka_frames, kafka_history,
)
from tickloom.sources.reference import (
    following_metadata, load_symbol_metadata, publish_symbol_metadata, symbol_metadata,
    symbol_reference, tracked_symbols,
)

__all__ = [
    "file_frames", "file_history", "following_metadata", "frames_from_events", "kafka_frames", "kafka_history",
    "load_symbol_metadata", "publish_symbol_metadata", "symbol_metadata",
    "symbol_reference", "tracked_symbols",
]
