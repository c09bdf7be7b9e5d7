"""mooclens: learning-analytics reports over course event logs, as Spark jobs.

Every report is a function ``op(tables..., **params) -> DataFrame`` that works on
all courses at once: ``course_id`` leads every grouping, join and window key.
"""

from mooclens.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
