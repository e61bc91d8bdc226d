"""tidemark: retail event and change-data analytics on Spark.

Page logs and database change records are read as tables or streams and
turned into daily-active-device facts, dimension snapshots, per-operation
fact feeds and dashboard answers, all with the DataFrame and Structured
Streaming APIs.  Every transform is ``DataFrame -> DataFrame`` and free of
actions, so one function serves batch and stream.
"""

__version__ = "0.1.0"
