"""callsight: sales-contact analytics as Spark DataFrame operators.

Layout: ``sources`` (readers, writers, driver-table adapter), ``functions``
(column expressions), ``operators`` (DataFrame -> DataFrame reports),
``plans`` (MLlib pipelines, scoring, recommendation), ``streaming``
(the same cleaning and scoring on a stream), ``catalog`` (named queries
with their DuckDB oracle text).
"""

from pyspark import cloudpickle as _cloudpickle

__version__ = "0.2.0"

# Python workers may not have this package on their path: the few functions
# that run in tasks travel with the query instead of by module name.
_cloudpickle.register_pickle_by_value(__import__(__name__))
