"""rowloom: cleaning, linking and scoring of semi-structured records on Spark.

Everything is a function from DataFrame to DataFrame.  The subpackages are

* ``functions``  column expressions (text normalisers, keys, dates, scores),
* ``sources``    readers, parsers of web pages and writers,
* ``operators``  relational operators built from those expressions,
* ``streaming``  the incremental variants,
* ``plans``      complete pipelines and the named queries,
* ``llm``        operators for training-data pipelines (optional).
"""

__version__ = "0.1.0"
