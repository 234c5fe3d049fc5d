"""Vehicle sales and service analytics as Spark DataFrame builders and Structured Streaming flows.

``functions``  column expressions: text repair, typing, flags
``operators``  DataFrame builders: cleaning, valid/rejected splits, latest-per-key, lookups
``sources``    feed schemas and the tab-separated reader (batch and stream)
``plans``      the two curated tables, table inspection, the whole refresh in order
``streaming``  append flows, keyed change application, external sinks
"""
