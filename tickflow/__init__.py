"""tickflow: sliding-window market analytics on Spark DataFrames.

Every public function takes DataFrames (or a SparkSession plus options)
and returns DataFrames; the same definitions run in batch and in
Structured Streaming.  Nothing here collects data to the driver.
"""

__version__ = "0.1.0"
