"""The modules whose QUERIES and SQL the driver's entry adds."""

from curaspark.llm import queries_records, queries_texts

MODULES = [queries_records, queries_texts]
