"""tidegate: dataset, feature, rule and graph analytics as plain Spark jobs."""

__version__ = "0.1.0"
