"""Structured Streaming forms of the event rules."""

from .debounce import debounce_stream
from .changed import changed_bursts, changed_stream
from .facets import facet_stream
from .runs import drain, late_rows, read_events, start, with_clock
from .search import count_settled, find_settled, search_stream, search_stream_counts, settled_queries, start_search
from .settings import settings_stream
from .toggles import toggle_all_stream, toggle_stream

__all__ = [
    "changed_bursts", "changed_stream", "count_settled", "debounce_stream", "drain", "facet_stream", "find_settled", "late_rows", "read_events",
    "search_stream", "search_stream_counts", "settings_stream", "settled_queries", "start", "start_search", "toggle_all_stream", "toggle_stream",
    "with_clock",
]
