"""cohortkit: cohort analytics as Spark DataFrame operators.

Every operator is a plain function ``DataFrame -> DataFrame`` (fit/apply
operators also return their fitted table).  Column names are arguments;
nothing depends on input row order.
"""

__version__ = "0.1.0"
