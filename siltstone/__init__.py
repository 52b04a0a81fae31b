"""Siltstone: layered analytical tables from nested JSON event feeds, on Spark.

Raw JSON lands day-partitioned, is typed and cleaned into Parquet, and is
modelled as a star schema, in batch or in Structured Streaming.  Every step is
a function from DataFrame to DataFrame built on Spark SQL functions.
"""

from siltstone.session import build_session, materialise, scratch_path, shared_dir

__all__ = ["build_session", "materialise", "scratch_path", "shared_dir"]
