"""statuta: Spark-native analytics over hierarchical statute documents.

The package is layered: ``functions`` (column expressions), ``operators``
(DataFrame to DataFrame transformations), ``sources`` (readers and writers),
``streaming`` (incremental variants) and ``plans`` (named queries and their
SQL).  ``llm`` holds the operators for training-data preparation; nothing
outside that subpackage imports it.
"""

__version__ = "0.1.0"
