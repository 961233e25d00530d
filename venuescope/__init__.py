"""venuescope: venue-listing analytics as Spark DataFrame operators.

Every operator is a function of DataFrames (and column-name / threshold
parameters) that returns a lazy DataFrame, so Catalyst plans the whole chain
and the same code runs on a laptop sample or a cluster.
"""

from venuescope.config import Params, REFERENCE, TEST_BINDING

__all__ = ["Params", "REFERENCE", "TEST_BINDING"]
