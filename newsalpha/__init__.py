"""Financial news to tradable signals, as Spark DataFrame operators."""
