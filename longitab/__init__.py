"""longitab: cleaning and analysing longitudinal study tables on Spark.

Every operator is ``DataFrame -> DataFrame`` (use it with ``df.transform``)
or ``Column -> Column``; nothing runs until the caller writes or collects,
except where a docstring says that a schema-sized result is read back.
"""

__version__ = "0.1.0"
