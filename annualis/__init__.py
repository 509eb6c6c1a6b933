"""PySpark operators for yearly series, measurements, outcomes and predictions."""
