"""Cohort indicators over scholarly works, and large text-corpus operators, on Spark."""
