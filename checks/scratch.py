"""Where queries that write tables put them."""

from txlake.sources.scratch import scratch_dir

__all__ = ["scratch_dir"]
