"""pitchlake: goal-probability analytics on Spark DataFrames.

Every public operator takes and returns a DataFrame (or a Column, for the
scalar helpers in ``pitchlake.functions``); nothing is collected to the
driver and no Python UDF is used.
"""

__version__ = "0.1.0"
