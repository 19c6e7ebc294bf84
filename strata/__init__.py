"""strata: layered (raw, Bronze, Silver) batch pipelines as Spark DataFrame plans."""

__version__ = "0.1.0"
