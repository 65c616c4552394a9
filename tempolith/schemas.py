"""Schemas and fixed values of the note-to-timeline data model."""

from __future__ import annotations

# fixed values: names and texts that tables, files and outputs of this kind hold, as they stand there
UNKNOWN = {"sact": "Unknown_SACT", "relation": "Unknown_relation", "time": "Unknown_time"}
INSTANT, DURATION, FAILED = "INSTANT", "DURATION", "FAILED_NORMALIZATION"
SENTINEL = -2147483648
EXACT, FUZZY, NOT_FOUND = "match_exact", "match_fuzzy", "not_found"
TABLE_HEADER = ("Medication", "Medication Text", "Temporal Relation", "Time Type", "TimeNorm ISO", "Normalized Time", "Temporal Expression")
SPAN_HEADER = ("Medication Normal", "Medication Text", "Medication Span", "Temporal Relation", "Normalized Time", "Time Text", "Time Span", "Time Type", "TimeNorm ISO")
MENTION_HEADER = ("Medication", "Temporal Relation", "TimeNorm ISO", "Normalized Time", "Temporal Expression", "Snippet")
# lines of a note's header: digits of a date and maybe of a time, letters of a record type
DATE_LINE = r"Principal Date[.]+(\d+)( \d+)?"
TYPE_LINE = r"Record Type[.]+([a-zA-Z ]+)"
# what a stream of messages ends with
STOP = "STOP"
# new tokens that a model may put out for one section
MAX_NEW_TOKENS = 16_000

#: the natural key of a document
DOC = ("patient_id", "doc_id")
TLINK_JSON = "array<struct<SACT:string,relation:string,time:string>>"
MENTION = "array<struct<begin:int,end:int,score:double,status:string>>"
TLINKS = "patient_id string, doc_id string, section_id int, pos int, sact string, relation string, time string"
RECORDED = "patient_id string, doc_id string, section_id int, llm_out string"
