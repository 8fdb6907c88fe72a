"""jobsift: a Spark-native engine for job-listing data.

Every operator is a function ``DataFrame -> DataFrame`` (or a Column
expression) built on the DataFrame / SQL / Structured Streaming API, so that
Catalyst plans it and the work is spread over the cluster.
"""

__version__ = "0.1.0"
