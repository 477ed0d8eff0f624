"""docflow: nested JSON documents to flat relational tables on Spark.

Every public function is ``DataFrame -> DataFrame`` (or returns a
``StreamingQuery`` / writes a sink) so it composes with ``df.transform``.
"""

__version__ = "0.1.0"
