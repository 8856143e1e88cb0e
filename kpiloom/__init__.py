"""kpiloom: network KPI analytics as Spark jobs.

Every operator takes and returns Spark DataFrames.  ``schema`` holds the data
contract, ``functions`` column expressions, ``operators`` relational steps,
``models`` detectors and forecasters, ``plans`` end-to-end pipelines and
``streaming`` the Structured Streaming forms.
"""
