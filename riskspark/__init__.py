"""riskspark: transaction-risk analytics as Spark DataFrame / SQL / Streaming jobs.

Layout
------
sources/    table readers, fixture views over the driver tables, sinks
functions/  column expressions (scalar functions, validation expectations)
operators/  DataFrame -> DataFrame operators (windows, joins, metrics, drift, models)
plans/      composite jobs (scoring, training, feedback, monitoring) and the query catalog
streaming/  Structured Streaming counterparts of the batch operators
"""

__version__ = "0.1.0"
