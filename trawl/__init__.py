"""trawl: web-corpus curation as Spark DataFrame jobs.

Layout
------
functions/  Column -> Column expressions (regex masks, tokenizer chain, hashing)
operators/  DataFrame -> DataFrame jobs (filters, dedup, sampling, metrics, models)
sources/    scans and sinks (driver tables, WARC/WET archives, text, manifests)
plans/      composed pipelines and the query registry with its SQL oracles
streaming/  incremental (file-stream) versions of the batch jobs
"""

__version__ = "0.1.0"
