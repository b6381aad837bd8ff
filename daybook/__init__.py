"""daybook: trustworthy daily data publishing on Spark.

Reusable DataFrame operators for typing, validating, deduplicating, upserting,
quality-gating and modelling daily batches of relational tables and JSON events.
"""

from daybook.context import RunContext, configure_session, checkpoint_dir

__all__ = ["RunContext", "configure_session", "checkpoint_dir"]
