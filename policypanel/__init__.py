"""policypanel: before/after policy-impact analytics as plain Spark DataFrame jobs.

Every public operator is ``DataFrame -> DataFrame`` and is built from built-in
Spark SQL functions only (no RDDs, no Python UDFs), so Catalyst can push filters
and projections into the scans and whole-stage codegen covers the hot path.

Sub-packages
------------
functions   column expressions (keys, tokens, flags, dates, ratios)
sources     CSV readers with explicit schemas, header-drift repair, yearly union
sinks       CSV / table writers, catalog registration, read-back verification
operators   cleaning, profiling, pre/post summaries, difference-in-differences
plans       the registered queries over the shared test tables (+ DuckDB oracle SQL)
streaming   the same aggregations over a file stream (incremental refresh)
"""

from policypanel.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
