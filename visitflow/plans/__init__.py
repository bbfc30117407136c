"""Composite reports, driver bindings and the query registry."""
