"""Label lists and label maps as people write them on a command line."""

from __future__ import annotations


def parse_labels(text: str | None) -> list[str] | None:
    """``"a, b"`` as a list; nothing given means all labels (None)."""
    labels = [part.strip() for part in (text or "").split(",")]
    return [label for label in labels if label] or None


def parse_label_map(text: str | None) -> dict[str, str] | None:
    """``"a=b, c=d"`` as a dict; an entry without both sides is an error."""
    if not text:
        return None
    pairs = {}
    for entry in filter(None, (part.strip() for part in text.split(","))):
        old, sign, new = (piece.strip() for piece in entry.partition("="))
        if not (sign and old and new):
            raise ValueError(f"label map entry {entry!r} is not of the form from=to")
        pairs[old] = new
    return pairs
