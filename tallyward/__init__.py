"""Tallyward: safety, spend and trial analytics as plain PySpark functions.

Everything is a function from Column to Column (``functions``) or from DataFrame
to DataFrame (``operators``, ``sources``, ``plans``, ``streaming``), so it composes
with ``df.transform`` and with ordinary Spark code.
"""
