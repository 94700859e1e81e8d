"""Structured Streaming forms: running counts, watermarked windows, TTL state."""

from tallyflow.streaming.forms import (
    DEFAULT_LAG, running_word_count, parsed_with_watermark, hierarchical_groups,
    roll_up_closed_windows, lookup_stream, top_n_closed_windows, route_stream, observe_rows)
from tallyflow.streaming.state import LatestWithTTL, latest_with_ttl_stream, read_state

__all__ = ["DEFAULT_LAG", "running_word_count", "parsed_with_watermark",
           "hierarchical_groups", "roll_up_closed_windows", "lookup_stream", "top_n_closed_windows",
           "route_stream", "observe_rows", "LatestWithTTL",
           "latest_with_ttl_stream", "read_state"]
