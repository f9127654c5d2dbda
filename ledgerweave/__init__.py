"""Finance analytics and fine-tuning data sets as Spark jobs."""

__version__ = "0.1.0"
