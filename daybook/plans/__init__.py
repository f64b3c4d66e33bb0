"""Whole plans: the landing-to-totals warehouse and the registered queries."""
