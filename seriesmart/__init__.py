"""seriesmart: statistical time-series files -> validated wide tables, on Spark."""

from . import functions, operators, plans, sinks, sources, streaming
from .session import build_session, ensure_checkpoint_dir, scratch_path

__all__ = ["functions", "operators", "plans", "sinks", "sources", "streaming", "build_session",
           "ensure_checkpoint_dir", "scratch_path"]
