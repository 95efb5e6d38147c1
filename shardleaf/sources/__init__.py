"""Where data comes from and goes to: pages, index entries, the index on disk, the catalogue, setting logs."""

from .catalog import section_catalog
from .entries import symbol_entries, nested_entries
from .index_store import read_index, read_shard, write_index
from .pages import extract_links, page_base, page_meta
from .settings import setting_log

__all__ = [
    "extract_links", "nested_entries", "page_base", "page_meta", "read_index", "read_shard", "section_catalog", "setting_log",
    "symbol_entries", "write_index",
]
