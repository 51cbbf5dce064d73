from reviewlens.streaming.ratings import (
    compact,
    latest_state,
    rating_updates,
    read_stream,
    run_available,
    stream_ratings,
)

__all__ = ["compact", "latest_state", "rating_updates", "read_stream", "run_available", "stream_ratings"]
