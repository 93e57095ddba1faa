"""Training-data operators: tokenising, fingerprints, filters, joins and archives.

Nothing outside this subpackage imports it.  ``queries`` and ``oracle_sql`` of
:mod:`vellumine.llm.queries` hold what the driver runs.
"""
