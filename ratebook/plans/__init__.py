"""Composed plans.

jobs     the four rate jobs as lazy plans, and runners with guards and sinks
catalog  the registered queries over the driver's tables
oracle   DuckDB twins of the registered queries
"""
