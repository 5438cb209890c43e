"""fundlake: a Spark-native funding-analytics pipeline.

Messy landing extracts are read tolerantly, cleansed into a conformed
(silver) layer, modelled as a star schema, governed with row and column
policies, and reported on.  Every operator takes and returns Spark
``DataFrame`` / ``Column`` objects so that Catalyst plans the whole chain.
"""

__version__ = "0.1.0"
