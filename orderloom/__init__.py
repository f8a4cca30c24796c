"""orderloom: a layered orders lake and usage-cost analytics as plain PySpark."""
