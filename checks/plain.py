"""The cleaning rules stated in plain Python, to check and to time the column expressions against."""

from __future__ import annotations

import re
import unicodedata


def clean(text: str | None) -> str:
    if not text:
        return ""
    text = re.sub(r"<[^>]+>", " ", unicodedata.normalize("NFC", text))
    text = "\n".join(line.rstrip() for line in re.sub(r"\r\n?", "\n", text).split("\n"))
    text = re.sub(r"\n{4,}", "\n\n\n", text).strip()
    for delimiter, dollars in {"\\[": "$$", "\\]": "$$", "\\(": "$", "\\)": "$"}.items():
        text = text.replace(delimiter, dollars)
    return text.translate(dict.fromkeys([0x200B, 0x200C, 0x200D, 0xFEFF]))
