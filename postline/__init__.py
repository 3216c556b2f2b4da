"""postline: job-posting records → clean relational model and star schema, as Spark jobs.

Subpackages: ``functions`` (column expressions), ``operators`` (DataFrame →
DataFrame jobs), ``sources`` (files, ledger, derived inputs), ``plans`` (the
model graph, ingest job, star layer, registered queries), ``streaming``
(continuous file ingest).
"""
