"""Operators for preparing training corpora: deduplication, scoring, scanning
and tokenising of whole documents. Nothing else in the library imports this
subpackage; its registered queries are in ``llm.queries``."""
