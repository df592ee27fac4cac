"""egoline: developer-activity timelines and follow graphs as Spark DataFrame jobs.

Every operator is a function from DataFrames to a DataFrame built from
built-in column expressions, so Catalyst can push filters into the scan,
prune columns, combine aggregates map-side and pick join strategies.
Nothing is collected to the driver and no Python UDF is used.
"""

__version__ = "0.1.0"
