"""docloom: full-refresh document building on Spark.

Extract relational tables, stage them, assemble nested documents with SQL,
shape and encode them, write a new version and point a public name at it.
Every step is a plain ``DataFrame -> DataFrame`` function.
"""

__version__ = "0.1.0"
