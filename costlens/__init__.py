"""costlens: compute-utilization and cost-risk analytics on Spark DataFrames.

Every operator is a pure function ``DataFrame -> DataFrame`` (or a ``Column``
rule) built from built-in Spark SQL functions; nothing here calls an action.
"""

from costlens.params import Params

__all__ = ["Params"]
