"""docgate: compliance screening of document records, as Spark jobs.

Sub-packages:

* ``functions`` - column expressions (text cleaning, JSON type coercion)
* ``sources``   - NDJSON scans, payload decoding, prompts, synthetic records
* ``operators`` - normalize, contract, gate, requests, scoring, replies, cost, admission
* ``sinks``     - insert-only tables, audit rows, dead letters, dated NDJSON
* ``plans``     - the batch job
* ``streaming`` - the stream job
"""
