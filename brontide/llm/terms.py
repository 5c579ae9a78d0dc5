"""Terms of a text: runs of ASCII letters and digits and of everything beyond ASCII, with A-Z in lower case."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

# By byte: what separates terms becomes a blank. Every byte of a character beyond ASCII is part of a term.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def folded(raw: bytes, most: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """Parts of about ``most`` bytes that end between terms, terms folded and all else blank, each with its first byte's place."""
    start = 0
    while start < len(raw):
        part = raw[start:start + most].translate(_FOLD)
        size = most
        while start + len(part) < len(raw) and (cut := part.rfind(b" ")) < 0:
            # One term longer than a part: read on until it ends.
            size *= 2
            part = raw[start:start + size].translate(_FOLD)
        if start + len(part) < len(raw):
            part = part[:cut + 1]
        yield start, part
        start += len(part)


def terms(raw: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, a bounded number of bytes at a time; a null has none."""
    for _, part in folded(raw or b""):
        yield part.split()


def raw_texts(texts: pa.Array) -> Iterator[bytes | None]:
    """The texts as UTF-8, one at a time."""
    for text in texts.cast(pa.large_binary()):
        yield text.as_py()
