"""Operators over telemetry and vehicle-month tables: DataFrame in, DataFrame out."""
