"""tidemark: subscription-business analytics on stock Spark.

Every dataset is a plain function from DataFrames to a DataFrame. Reading and
writing live in ``sources`` and ``streaming``; cleaning in ``operators``;
business tables in ``plans``.
"""
