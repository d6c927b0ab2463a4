"""Training-data operators: dedup, decontamination, classifiers, tokenisation, WARC archives.

``queries()`` / ``oracle_sql()`` collect what the modules of this subpackage register; nothing outside the
subpackage imports it except the guarded hook in ``__spark_entry__.py``.
"""
