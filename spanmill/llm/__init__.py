"""Operators of a training-data pipeline over documents, pages and conversations.

Nothing outside this subpackage imports it (``__spark_entry__.py`` adds its queries only
when it is present)."""
