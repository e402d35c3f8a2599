"""Phrase and hashtag trends over social posts, as Spark DataFrame jobs.

``sources``    CSV and message scans, table sinks, the serving store
``functions``  column expressions: text cleaning, n-grams, field clean-up
``operators``  DataFrame -> DataFrame steps: usage counts, rankings, merges, lookups
``plans``      the batch build and the lookup, put together from the operators
``streaming``  replay-safe monthly counters fed by micro-batches
``checks``     the registered queries, their input adapters and oracle SQL
"""
