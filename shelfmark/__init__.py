"""Retail lakehouse on PySpark: bronze, silver and gold tables as lazy DataFrame plans."""
