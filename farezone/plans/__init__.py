"""Composite plans: the trips mart, zone financials, fare tables, FHV totals."""
