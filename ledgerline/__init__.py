"""Bank customer, risk and revenue analytics as plain Spark DataFrame functions.

Layout
------
``schemas``     declared tables (types, NOT NULL, defaults, keys, layout)
``rules``       the fixed values every rule-based report uses
``functions``   column expressions
``operators``   reusable DataFrame steps (exact distributed NTILE, bounded collect, ...)
``sources``     builders, readers, writers and retention of the star schema
``plans``       the reports: segmentation, churn, cross-sell, AML, profit and loss
``streaming``   incremental landing of files
"""
