"""edustar: student-performance analytics on Spark.

Layers (``plans.warehouse``): raw tables → silver → star schema (four
dimensions, submission-grain fact) → staging → five marts; report cards
(``operators.reports``) and data-quality checks (``operators.quality``) on
top. ``plans.catalog.QUERIES`` maps every query name to a DataFrame builder.
"""
