"""Sources: thin shells around ``spark.read`` / ``spark.readStream``."""
