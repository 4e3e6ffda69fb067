"""quarry: a Spark-native positional text index, boolean search and document clustering engine.

Every operator takes and returns DataFrames; nothing data-sized is collected to the driver.
"""

__version__ = "0.1.0"
