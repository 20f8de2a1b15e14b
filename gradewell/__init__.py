"""Academic-performance analytics expressed as Spark DataFrame operators.

Raw exam attempts are cleaned (``operators.cleaning``), joined with the
curriculum (``operators.enrichment``), arranged as a star schema
(``operators.dimensions``, ``operators.fact``) and summarised into KPI tables
(``plans``).  ``plans.warehouse`` names the tables and stores the layers.
"""
