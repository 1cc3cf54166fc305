"""Spark-native link ranking, ordered exports and labelled-feature jobs.

Sub-packages: ``sources`` (readers), ``operators`` (DataFrame -> DataFrame
steps), ``functions`` (column expressions), ``plans`` (whole jobs), ``sinks``
(writers).
"""
