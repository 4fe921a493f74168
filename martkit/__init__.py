"""martkit: Spark-native data-mart operators.

Every operator takes DataFrames and returns a DataFrame; all row work is
expressed with Spark SQL expressions so Catalyst can prune, push down and
code-generate it.  The run time is always a parameter (``run_ts``) so that
results repeat.
"""

from martkit.session import build_session

__all__ = ["build_session"]
