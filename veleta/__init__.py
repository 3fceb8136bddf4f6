"""Spark-native analytics for social posts: bronze to silver to gold, classifiers,
A/B comparison, labelled sentiment data sets and a triple table over posts.

Every operator is a function from DataFrames to a DataFrame and stays lazy; the few
places that must materialise (exact ranks, model fitting, stream sinks) say so.
"""

__version__ = "0.1.0"
