"""Whole batch plans: receivable offers, payable offers, reports."""
