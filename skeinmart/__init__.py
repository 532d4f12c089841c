"""skeinmart: a retail star-schema batch engine written as Spark DataFrame jobs."""

__version__ = "0.1.0"
