"""mallscope: retail behaviour and ad-click analytics on Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions, joins, aggregations and windows, so Catalyst plans it and the
same function serves batch and streaming inputs where Spark allows it.
"""

from mallscope.session import get_session, checkpoint_root

__all__ = ["get_session", "checkpoint_root"]
