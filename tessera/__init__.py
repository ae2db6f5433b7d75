"""tessera: keyed feature tables, training-set assembly, model fitting,
metrics, scoring and drift monitoring expressed as Spark DataFrame plans."""

__version__ = "0.1.0"
