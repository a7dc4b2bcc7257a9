"""Daily-snapshot analytics on PySpark.

Every public operator is a plain ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function.  Nothing here creates a session, changes its settings or runs Python in tasks.
"""

__version__ = "0.1.0"
