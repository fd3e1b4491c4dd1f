"""lodegraph: a Spark-first engine for program graphs, their documents and the corpora built from them."""

__version__ = "0.1.0"
