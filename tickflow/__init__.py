"""tickflow: price-tick ingest, marts, monitoring and dashboards as Spark jobs.

Every public function takes and returns DataFrames (or Columns); nothing is
collected to the driver except one-row scalars (an ``as_of`` bound, a batch
count).  Every ``now()`` of the original pipeline is an explicit ``as_of``
argument so that results are reproducible.

Layout:
  functions/   Column-level helpers (calendar, ids, time, formatting)
  sources/     readers, fixture tables derived from the driver tables, sinks
  operators/   ingest, validation, marts, quality checks, monitoring, dashboards
  plans/       multi-step plans: scalable sequential ops, incremental builds
  streaming/   Structured Streaming jobs (ingest, windowed marts, dedup)
"""

__all__ = ["session", "dims"]
