"""atelier: design-corpus pipelines as Spark DataFrame operators.

Subpackages: ``functions`` (column expressions), ``operators`` (DataFrame
to DataFrame operators), ``plans`` (plan-document contract checks),
``sources`` (scans and sinks), ``streaming`` (incremental intake) and
``scenarios`` (the registered queries over the driver's tables).
"""

__version__ = "0.1.0"
