"""Training-data operators: packing, PII, decontamination, near-duplicates,
quality, token files, URL filters, secrets, language ID and fingerprints.

Nothing outside this subpackage imports it.  ``queries.py`` holds the thin
``opN_<name>`` queries, ``oracle.py`` their DuckDB SQL where SQL can say it.
"""
