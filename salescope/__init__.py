"""salescope: validation, cleaning and statistics for sales tables on Spark.

Every public operator takes a DataFrame (plus parameters) and returns a
DataFrame; the work runs as Spark jobs (scans, aggregates, joins, windows).
"""

from salescope.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
