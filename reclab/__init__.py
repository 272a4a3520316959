"""reclab: implicit-feedback recommendation and ranking evaluation on Spark.

Every operator takes DataFrames and returns DataFrames.  Solvers come from
Spark ML; everything else is DataFrame / SQL so Catalyst plans it.
"""

__version__ = "0.1.0"
