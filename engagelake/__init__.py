"""engagelake: Spark-native media-engagement analytics.

Layers: bronze envelopes (``sources.bronze``) -> silver tables
(``plans.silver``) -> gold star schema (``plans.gold``) -> quality checks
(``plans.checks``) and reports (``plans.reports``); daily and incremental
runs in ``plans.workflow``; streaming forms in ``streaming``.
"""
