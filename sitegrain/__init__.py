"""sitegrain: Spark-native cleaning, matching and scoring of crawled site records."""

__version__ = "0.1.0"
