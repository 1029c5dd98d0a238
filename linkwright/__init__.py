"""Record linkage and training-data preparation as Spark plans."""
