"""paperweave: scholarly works snapshot -> relational tables and citation graph, on Spark."""

__version__ = "0.1.0"
