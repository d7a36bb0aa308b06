"""skyledger — forecast-quality analytics expressed as Spark DataFrame plans.

Layers: daily documents -> RAW -> ODS -> DM (per dataset) -> forecast-error mart,
newest-version reads, analytic queries, coverage/backfill planning and
request-state streams. Every operator takes DataFrames and returns DataFrames.
"""

from skyledger.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
