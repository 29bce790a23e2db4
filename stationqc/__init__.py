"""Station-observation quality control on Spark.

Every operator is a lazy ``DataFrame -> DataFrame`` function.  Observations are
kept in long form ``(t, sid, v)``; the time x station matrix of the original
workflow is never materialised as a wide table except for export.
"""

__version__ = "0.1.0"
