"""Spark-native customer-attrition analytics.

Raw, untrusted CSV is profiled, converted to a typed schema in which bad
values become NULL, reduced to the latest record per customer, banded, and
summarised as quality checks, statistics and grouped attrition rates.  Every
step is a DataFrame operator built from Spark's own expressions so Catalyst
plans and optimises the whole job.
"""

from churnlens.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
