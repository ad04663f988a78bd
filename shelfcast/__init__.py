"""shelfcast: demand planning over wholesale sales and stock files, as Spark jobs.

Every public function takes DataFrames and returns DataFrames.  Nothing here
runs a Spark action except the writers and :func:`shelfcast.durable.settle`.
"""

__version__ = "0.1.0"
