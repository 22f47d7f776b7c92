"""claimlens: claim classification and evidence analytics on Spark."""

__version__ = "0.1.0"
