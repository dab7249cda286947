"""chatloom: dialogue-data, retrieval and log analytics as Spark DataFrame operators."""
