"""Retail order analytics on PySpark: sources, rules, table changes, reports and exports."""
