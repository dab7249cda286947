"""All registered queries of the library's own operators, and their SQL twins."""

from __future__ import annotations

from . import curation_queries, dialogue_queries, eval_queries, io_queries, more_queries, retrieval_queries, stream_queries, text_queries

QUERIES, SQL = {}, {}
for module in (text_queries, dialogue_queries, curation_queries, retrieval_queries, eval_queries, more_queries, stream_queries, io_queries):
    QUERIES |= module.QUERIES
    SQL |= module.SQL
