"""tabulon: data operators for the whole life of a tabular classification project.

Every operator takes and returns Spark DataFrames.  The only things that reach the
driver are results whose size is bounded by the number of columns, bins, classes or
partitions.
"""
