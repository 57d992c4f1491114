"""Clinical-risk analytics as Spark jobs: clean, score, report, stream, train."""

__version__ = "0.1.0"
