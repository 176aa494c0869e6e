"""strata: layered (raw -> clean -> business) order analytics on Spark.

Every public function takes and returns DataFrames; only the modules under
``strata.sinks`` and ``strata.plans`` write. Row data never enters Python:
all work is expressed with the DataFrame API / Spark SQL so Catalyst can
prune, push down and plan the shuffles.
"""

from strata.session import build_session, work_root

__all__ = ["build_session", "work_root"]
