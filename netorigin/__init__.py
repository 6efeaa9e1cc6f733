"""IP-origin analytics as Spark DataFrame operators."""
