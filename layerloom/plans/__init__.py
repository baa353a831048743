"""Runs that combine operators: the layered day, its run metrics, trend series."""
