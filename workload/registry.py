"""All checked queries."""

from workload import runs, similarity, tables, texts

CHECKS = {**texts.CHECKS, **tables.CHECKS, **runs.CHECKS, **similarity.CHECKS}
