"""How the work is laid out on a cluster: size-checked broadcasts, split groups, durable cuts."""

from .bounds import broadcast_if_small
from .durable import cut_lineage, scratch, shared_dir
from .ordered import last_known, neighbours, numbered, running_sums
from .prefixes import prefix_ranges

__all__ = [
    "broadcast_if_small", "cut_lineage", "last_known", "neighbours", "numbered", "prefix_ranges", "running_sums", "scratch", "shared_dir",
]
