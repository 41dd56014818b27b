"""Question/answer corpus preparation and answer scoring as PySpark DataFrame operators."""
