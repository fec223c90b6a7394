"""Farm analytics as Spark DataFrame jobs.

``sources``   reading, landing and registering farm data
``functions`` column expressions: fixed-point sums, bands, agronomy
``operators`` DataFrame -> DataFrame building blocks
``plans``     the composed datasets: conformed tables, marts, views, charts
``streaming`` incremental forms of the same jobs
"""
