"""Quayside: supply-chain risk analytics as Spark DataFrame jobs.

Layers, from the outside in:

* ``sources``    landed files to raw tables, and tables back to storage
* ``functions``  column expressions shared by several operators
* ``operators``  DataFrame-to-DataFrame building blocks
* ``plans``      models and reports composed from operators
"""
