"""All registered queries by name."""

from tidemark.catalog import building, checking, keeping, reading

QUERIES = {**reading.QUERIES, **keeping.QUERIES, **checking.QUERIES, **building.QUERIES}
