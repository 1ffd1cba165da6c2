"""ladle — restaurant and delivery analytics as lazy Spark DataFrame operators.

Every public operator takes DataFrames and returns a DataFrame; nothing is
collected inside an operator except bounded name lists and fitted models.
"""

__version__ = "0.1.0"
