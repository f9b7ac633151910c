"""leadscope: lead-quality analytics on Spark DataFrames.

Every operator is a lazy ``DataFrame -> DataFrame`` function. Nothing is
collected to the driver; ``as_of`` dates are explicit parameters so a report
is reproducible and testable against an independent SQL engine.
"""

__version__ = "0.1.0"
