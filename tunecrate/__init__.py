"""Recommendation analytics on Spark DataFrames.

``functions``  column expressions (vectors, ids, measures, seeded order)
``operators``  DataFrame in, DataFrame out: recall, lists, similarity, factors, ranking
``sources``    readers for delimited text contracts and partitioned sinks
``plans``      named queries over the warehouse tables, with their SQL twins
"""
