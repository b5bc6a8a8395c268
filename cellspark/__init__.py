"""cellspark: partitioned, clustered, last-write-wins tables as Spark DataFrames."""

from cellspark.spec import TableSpec, ViewSpec

__all__ = ["TableSpec", "ViewSpec"]
