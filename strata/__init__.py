"""strata — layered (bronze / silver / gold) analytics on Spark DataFrames.

Sub-packages:

* ``functions``  Column -> Column builders (cleaning, decoding, casts, JSON, measures)
* ``sources``    table read / write / stamp / clustered layout / stream landing
* ``operators``  DataFrame -> DataFrame building blocks (dedup, quality, reshape, star joins)
* ``plans``      the silver and gold recipes and the query catalogue
* ``streaming``  Structured Streaming version of the latest-measurement views
"""

__version__ = "0.1.0"
