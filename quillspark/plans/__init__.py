"""The registered queries and their SQL."""

from quillspark.plans import functions, letters, pages, queries, rules, texts, vectors  # noqa: F401  (the others add to the registry of queries)
