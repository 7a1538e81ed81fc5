"""Code-corpus analytics as Spark jobs: extraction, curation, leakage audit, statistics."""

__version__ = "0.1.0"
