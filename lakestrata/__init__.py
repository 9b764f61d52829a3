"""lakestrata: reusable Spark DataFrame operators for a bronze → silver → gold event lake.

Every function takes and returns DataFrames (sinks excepted) so Catalyst sees one plan per
report: filters and column pruning reach the Parquet scan, and no stage is scheduled by hand.
"""

from lakestrata.session import build_session, configure, scratch_dir

__all__ = ["build_session", "configure", "scratch_dir"]
