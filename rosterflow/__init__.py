"""rosterflow: enrollment-roster reconciliation and reporting on Spark DataFrames."""

__version__ = "0.1.0"
