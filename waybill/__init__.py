"""Waybill: load-confirmation documents to tables, on Spark."""
