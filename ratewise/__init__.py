"""ratewise: recommendation analytics written on Spark DataFrames.

Sub-packages
------------
sources    readers and writers (delimited text, Parquet, JSON event log, manifests)
functions  column expressions (text parsing, multi-hot, time, vectors, JSON)
operators  DataFrame -> DataFrame building blocks (cleaning, features, split,
           ranking, metrics, drift, concentration, request metrics, runs)
models     recommenders fitted and applied as distributed jobs
plans      end-to-end jobs and the query catalogue over the driver's tables
streaming  Structured Streaming drain and windowed monitoring
"""

__version__ = "0.1.0"
