"""Batch jobs that move book records through Bronze, Silver and Gold tables on Spark."""
