"""sylvan: tabular ML preparation and tree modelling on PySpark.

Profile a table's columns, select columns by quality, clean and derive
columns, index and assemble features, train tree models, then evaluate,
tune, explain and score them. Everything is expressed with DataFrames,
Spark SQL functions and Spark ML stages; the driver only composes plans
and holds model-sized objects (label arrays, tree nodes), never data.
"""

from sylvan.session import checkpoint_dir, get_session, scratch_path

__all__ = ["checkpoint_dir", "get_session", "scratch_path"]
__version__ = "0.1.0"
