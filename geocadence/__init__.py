"""geocadence: regional hazard indicators as Spark DataFrame operators.

Layout
------
functions/  Column builders (time, geometry, text, cell arithmetic)
operators/  DataFrame -> DataFrame operators
sources/    readers and writers
plans/      compositions of operators (rain, soil moisture, scenarios, predictors)
streaming/  Structured Streaming versions of the realtime steps
catalog/    the demonstration queries on the driver tables, each with its SQL twin
"""
