"""Training-data operators: tokens, licences, duplicates, mixing, search,
decontamination, secrets, quality and web archives.

Nothing else in the package imports this subpackage; the queries it
registers are in :mod:`kestrel.llm.queries`.
"""
