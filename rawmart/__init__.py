"""rawmart: a PySpark raw -> staging -> mart engine for captured JSON API data.

Everything is DataFrame code on built-in Spark functions. Sub-packages:

* ``functions``  Column -> Column helpers (JSON scalars, truthiness, safe casts, time zones, buckets)
* ``sources``    captured response bodies, page unwrapping, landing/raw JSONL, dead-letter sink, config text
* ``operators``  quality split, latest-per-key, array alignment, upsert (merge), cursors
* ``plans``      zone steps (raw, staging, mart), consumer queries, the run orchestration
* ``streaming``  availableNow file stream into the upsert

``rawmart.session`` holds the session settings and scratch handling, ``rawmart.fixed`` the values the
results share with the reference job, ``rawmart.queries`` the registered queries with their oracles,
and ``python -m rawmart`` runs one ingestion run as a job.
"""
