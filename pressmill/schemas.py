"""Schemas of the files the library reads."""

from __future__ import annotations

from pyspark.sql import types as T

from pressmill.constants import CLAIM_COLUMNS


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


ARTICLE = T.StructType(_strings("id", "type", "content", "domain", "title", "authors", "url"))
PROCESSED = T.StructType(_strings("id", "type", "processed_text"))
PROCESSED_META = T.StructType(
    _strings("id", "type", "processed_text", "domain", "title", "authors")
)
CLAIM = T.StructType([
    T.StructField(name, T.IntegerType() if name.endswith("_counts") else T.StringType())
    for name in CLAIM_COLUMNS
])

# The provided tables; stating the schema spares a job that reads a footer.
TABLES = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
