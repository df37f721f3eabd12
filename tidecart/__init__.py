"""Real-time shop analytics as plain Spark DataFrame transformations.

``functions``  column expressions (time, text, labels)
``operators``  frame-to-frame building blocks (lookup join, first/latest row, counters, windows, paging)
``sources``    Kafka, file and control-table readers
``sinks``      topic routing and the replay-safe batch ledgers
``plans``      the warehouse steps as batch transformations, and the serving queries
``streaming``  the same steps under Structured Streaming
``demo``       maps TPC-H-like tables to the shop's tables
"""
