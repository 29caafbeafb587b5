"""tablehaul — land, shape, move and publish relational tables with Spark.

Every operator returns a lazy DataFrame (or writes through a DataFrameWriter);
Catalyst plans the work, Spark schedules it.
"""

__version__ = "0.1.0"
