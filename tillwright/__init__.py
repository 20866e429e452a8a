"""tillwright: retail curation, star schema and sales reporting on Spark DataFrames.

The layers, bottom up:

``functions``  column rules (text, numbers, dates, measures): ``Column`` in, ``Column`` out
``operators``  table operators (one row per key, references, dense keys, checks, ranking)
``sources``    declared schemas, CSV readers, tables, views and namespaces
``plans``      curated entities, sales and marts, star schema, reports, validation, full build
``streaming``  the same curation on a stream of new orders
"""
