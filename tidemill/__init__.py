"""Tidemill: streaming-analytics operators and ready-made views for PySpark.

Layout
------
``functions``  column-level helpers (rounding, scores, JSON, geo, vectors, UDFs)
``operators``  DataFrame-level operators (windows, frames, joins, folds, top-n)
``sources``    decoding, CDC changelogs, file and connector readers, profiling
``sinks``      append, upsert, message and lake writers, change feeds
``plans``      the ready-made views, each a pure function of DataFrames
``streaming``  runners that keep a plan up to date on Structured Streaming
``checks``     the plans bound to the sample tables, with their SQL oracle
"""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers by value, so executors
# need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
