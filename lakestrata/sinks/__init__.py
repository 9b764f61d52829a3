from lakestrata.sinks.parquet import spread_by_day, write_bounded_by_day, write_partitioned, write_plain

__all__ = ["spread_by_day", "write_bounded_by_day", "write_partitioned", "write_plain"]
