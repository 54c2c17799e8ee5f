"""starmart: order events -> bronze -> silver -> SCD2 star schema -> marts, on Spark.

Every stage is a function ``DataFrame -> DataFrame``; I/O happens only in
``sources`` (reads, snapshot publishes) and ``streaming`` (Structured
Streaming sinks).  Nothing here loops over rows on the driver.
"""

__all__ = ["session", "functions", "sources", "operators", "plans", "streaming"]
