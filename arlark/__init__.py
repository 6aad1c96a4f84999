"""Accounts-receivable analytics on Spark."""
