"""Analytics over daily weather observations, expressed as Spark DataFrame plans."""
