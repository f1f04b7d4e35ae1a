"""Daily ad-campaign performance on Spark DataFrames.

Everything in this package is a ``DataFrame -> DataFrame`` function (or a
write that ends such a chain), built from JVM-side column expressions only.
"""

__version__ = "0.1.0"
