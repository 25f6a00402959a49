"""Registered queries, each with the SQL that gives the same rows where SQL can."""

from checks import assets, chunks, conversations, ingest, instruct, rules, streams, tokens
from checks.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "assets", "chunks", "conversations", "ingest", "instruct", "rules", "streams", "tokens"]
