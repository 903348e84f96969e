"""Zstandard compressors with raw-content dictionaries, and plain-text windows."""

from __future__ import annotations

from collections.abc import Iterator

import zstandard

#: Bytes of lower-cased UTF-8 text that are kept; all other bytes become blanks.
LETTERS = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def letters_only(text: str) -> bytes:
    """Lower-cased UTF-8 with every run of ASCII non-letters as one blank."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(LETTERS).split())


def compressor(content: bytes, level: int) -> zstandard.ZstdCompressor:
    """A compressor whose only prior knowledge is ``content``; frames carry no optional fields."""
    fields = {"level": level, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if len(content) < 8:  # too short for a dictionary
        return zstandard.ZstdCompressor(**fields)
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(level=level)
    return zstandard.ZstdCompressor(dict_data=dictionary, **fields)


def windows(data: bytes, size: int) -> Iterator[bytes]:
    for at in range(0, len(data), size):
        yield data[at:at + size]
