"""One form of CSV for all that is read and written: quotes doubled, blanks kept, empty text apart from null."""

from __future__ import annotations

_SHARED = {"header": "true", "quote": '"', "escape": '"'}
CSV_WRITE = {
    **_SHARED,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "",
    "emptyValue": '""',
}
# a cell without quotes and text is null, one of two quotes is empty text: what stands for null must not be empty
CSV_READ = {
    **_SHARED,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\u0001",
    "emptyValue": "",
}
# texts that may hold line breaks; a file is then read by one task
CSV_READ_MULTILINE = {**CSV_READ, "multiLine": "true"}
