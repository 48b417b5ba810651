"""jobloom: a Spark-native engine for collecting, de-duplicating, searching and ranking job advertisements.

Everything is expressed as DataFrame plans.  The only Python that runs inside tasks is one Arrow-batched
helper (multi-pattern position search, ``functions.positions``).
"""

__version__ = "0.1.0"
