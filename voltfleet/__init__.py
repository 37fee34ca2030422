"""Fleet battery-health analytics as Spark DataFrame operators."""
