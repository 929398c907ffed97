"""Cohort analytics and risk scoring on Spark DataFrames."""
