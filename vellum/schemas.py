"""Declared schemas; nothing is inferred."""

from __future__ import annotations

LOCATION = "STRUCT<line:INT,column:INT,offset:INT>"
PLACEHOLDERS = "ARRAY<STRUCT<token:STRING,raw:STRING,kind:STRING,locked:BOOLEAN>>"
SYNTAX = "STRUCT<renderer:STRING,command:STRING,argument:INT,quote:STRING,quoted:BOOLEAN,label:STRING>"
CATALOG = (
    f"id STRING, file STRING, type STRING, source STRING, translation STRING, status STRING, source_hash STRING, raw_source STRING, start {LOCATION}, "
    f"end {LOCATION}, label STRING, menu_target STRING, context_before STRING, context_after STRING, confidence STRING, reason STRING, "
    f"placeholders {PLACEHOLDERS}, syntax {SYNTAX}"
)
GLOSSARY = (
    "id STRING, category STRING, source STRING, confidence STRING, status STRING, origin STRING, reason STRING, entity_ids ARRAY<INT>, "
    "occurrences BIGINT, file_count BIGINT, source_refs ARRAY<STRING>, examples ARRAY<STRING>"
)
ARCHIVE = "entry_index INT, volume INT, link_no INT, name STRING, mtime TIMESTAMP, size INT, data BINARY, warning STRING"
