"""corpusflow: a Spark-native news/document corpus engine.

Landed API answers and fetched pages are DataFrames; every step after the
HTTP call (extraction, cleaning, arrival-order dedup and poll-stop rules,
chunking, embedding, vector search, count tables, Q&A quality figures) is a
DataFrame / SQL / Arrow-UDF job that runs on the executors.
"""

__version__ = "0.1.0"
