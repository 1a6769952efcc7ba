"""leadtime: point-in-time risk analytics as lazy Spark DataFrame operators."""
