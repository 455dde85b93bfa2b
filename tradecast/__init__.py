"""tradecast — Spark-native analytics for seasonal, perishable trade data.

Every public operator is a function ``DataFrame -> DataFrame`` (or takes a
bundle of role DataFrames) and stays lazy: nothing is collected to the driver.

Layout
------
``sources``    role bindings over the driver tables, raw schemas, CSV / parquet IO
``functions``  column expressions (text, dates, exact rounding)
``operators``  reusable relational building blocks (cleaning, contracts,
               profiling, distributed ntile, series windows, grouped statistics)
``plans``      end-to-end queries: questions, marts, measures, EDA, forecasting
``streaming``  incremental ingest of raw files with Structured Streaming
``oracle``     independent DuckDB SQL used only by the correctness check
"""

from tradecast.session import get_session, scratch_dir  # noqa: F401

__all__ = ["get_session", "scratch_dir"]
