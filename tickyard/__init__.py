"""tickyard: market-trade analytics as PySpark DataFrame functions.

Every transformation takes and returns a DataFrame and is written with
built-in ``pyspark.sql.functions`` so that Catalyst keeps it inside
whole-stage codegen.  Batch and streaming share the same functions unless
a docstring says otherwise.
"""

__version__ = "0.1.0"
