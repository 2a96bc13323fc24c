from shardloom.streaming.intake import run_to_end, stream_bundles
from shardloom.streaming.states import (
    latest_from_updates, stream_latest_states, stream_state_events,
)
from shardloom.streaming.taken import read_taken, stream_bundles_once, taken_rows

__all__ = ["latest_from_updates", "read_taken", "run_to_end", "stream_bundles", "stream_bundles_once",
           "stream_latest_states", "stream_state_events", "taken_rows"]
