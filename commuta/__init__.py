"""Land-use and travel-demand analytics as Spark DataFrame operators."""
