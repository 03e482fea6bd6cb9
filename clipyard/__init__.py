"""clipyard: crawled-article extraction, search and near-duplicate analytics on Spark.

The package is a set of DataFrame-in / DataFrame-out functions:

* ``functions``  column expressions (tokenizers, min-hash, keys, JSON)
* ``sources``    how tables and messages come in (snapshots, tasks, logs)
* ``operators``  extraction, crawl, search, near-duplicates, log routing
* ``sinks``      how articles, messages and logs are written
* ``streaming``  the same work as Structured Streaming queries
* ``plans``      the command menu and the registered queries with their SQL twins
"""
