"""Swath and grid analytics on Spark: readers, projections, resampling, composites, enhancement, comparison."""
