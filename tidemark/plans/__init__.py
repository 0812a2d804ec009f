"""Whole paths from landed logs to published events, and the registered queries."""
