"""Restaurant point-of-sale analytics on Spark.

Landed JSON documents in, a star schema of four fact and four dimension tables
out. Everything is expressed with the DataFrame API and built-in functions.
"""
