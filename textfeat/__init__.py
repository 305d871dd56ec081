"""Text features and subject classifiers on Spark DataFrames.

``functions``  column expressions: file names, text cleaning, tokens, hashing, scores
``sources``    readers and writers: text library, stop words, RDF metadata, datasets
``operators``  DataFrame -> DataFrame steps, lazy unless their docstring names an action
``plans``      staging in the shared folder, size checks, whole runs
``streaming``  document-frequency state kept up to date from arriving documents
``catalog``    the registered queries and their SQL counterparts
"""

__version__ = "0.1.0"
