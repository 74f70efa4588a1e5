"""pitchlake: a Spark-native fantasy-football analytics library.

Every operator is a DataFrame -> DataFrame (or Column -> Column) function
built on the public PySpark API so Catalyst/AQE plan the physical work.
"""

__version__ = "0.1.0"
