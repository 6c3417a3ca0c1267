"""quarry: text-frequency, table-cleaning, feature-preparation, model-training
and model-evaluation operators written as Spark DataFrame plans."""

__version__ = "0.1.0"
