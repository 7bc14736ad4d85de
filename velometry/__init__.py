"""Bike-share and taxi analytics as lazy PySpark DataFrame plans.

``sources`` reads and writes the tables, ``functions`` holds column
expressions, ``operators`` the analyses, and ``plans`` whole jobs and the
catalogue of named queries.
"""
