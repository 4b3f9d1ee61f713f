"""gatelake: analytics over hardware-description source corpora as Spark tables."""
