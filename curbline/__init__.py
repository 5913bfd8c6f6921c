"""Trip records on Spark: conform, clean, key, merge, join and summarise.

Every operator takes and returns a ``DataFrame`` (or builds a ``Column``), so
operators chain with ``df.transform`` and Spark plans the whole chain at once.
"""
