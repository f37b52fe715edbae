"""Training-data pipeline operators (tokenization, filtering, de-duplication, scans).

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its queries
only when the subpackage is present.
"""
