"""Word bytes of whole texts: runs of ASCII letters and digits and of non-ASCII bytes."""

from __future__ import annotations

_KEEP = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
#: A-Z to lower case, everything that is no word byte to a space.
TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEEP else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; null has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(TABLE).split()
