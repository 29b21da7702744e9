"""trailmart: a Spark-native analytics engine for click-and-booking interaction logs."""

__version__ = "0.1.0"
