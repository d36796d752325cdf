"""Reading a ZIP package by ranges: directories, stored members, records inside them.

Only what is asked for is read: the end of the file, the central directory, a
member's local header, and the bytes of a record. Nothing is extracted.
"""

from __future__ import annotations

import struct
import zlib
from typing import NamedTuple

#: Signatures and the marks for "see the ZIP64 field" of the ZIP format.
END, END64_LOCATOR, END64, CENTRAL, LOCAL = b"PK\5\6", b"PK\6\7", b"PK\6\6", b"PK\1\2", b"PK\3\4"
MARK16, MARK32 = 0xFFFF, 0xFFFFFFFF
STORED, DEFLATED = 0, 8
END_BYTES, LOCATOR_BYTES, END64_BYTES, LOCAL_BYTES = 22, 20, 56, 30


class Member(NamedTuple):
    name: str
    method: int
    packed: int
    size: int
    header: int


class Archive:
    """``read(offset, size)`` gives bytes of the file, ``length`` is its size."""

    def __init__(self, read, length: int):
        self.read, self.length = read, length

    def members(self) -> list[Member]:
        tail_at = max(0, self.length - END_BYTES - MARK16)
        tail = self.read(tail_at, self.length - tail_at)
        at = tail.rfind(END)
        # A comment may hold the signature: the right one's comment ends with the file.
        while at >= 0 and at + END_BYTES + int.from_bytes(tail[at + 20 : at + 22], "little") != len(tail):
            at = tail.rfind(END, 0, at)
        if at < 0:
            raise ValueError("no end of central directory: not a ZIP file, or cut short")
        count, size, start = struct.unpack_from("<HII", tail, at + 10)
        if count == MARK16 or size == MARK32 or start == MARK32:
            count, size, start = self._zip64(tail_at + at)
        return self._directory(self.read(start, size), count)

    def _zip64(self, end_at: int) -> tuple[int, int, int]:
        locator = self.read(end_at - LOCATOR_BYTES, LOCATOR_BYTES) if end_at >= LOCATOR_BYTES else b""
        if locator[:4] != END64_LOCATOR:
            raise ValueError("ZIP64 locator missing")
        end = self.read(struct.unpack_from("<Q", locator, 8)[0], END64_BYTES)
        if end[:4] != END64:
            raise ValueError("ZIP64 end of central directory missing")
        return struct.unpack_from("<QQQ", end, 32)

    @staticmethod
    def _directory(data: bytes, count: int) -> list[Member]:
        found, at = [], 0
        for _ in range(count):
            if data[at : at + 4] != CENTRAL:
                raise ValueError("central directory damaged")
            flags, method = struct.unpack_from("<HH", data, at + 8)
            packed, size = struct.unpack_from("<II", data, at + 20)
            n_name, n_extra, n_comment = struct.unpack_from("<HHH", data, at + 28)
            (header,) = struct.unpack_from("<I", data, at + 42)
            name = data[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra = data[at + 46 + n_name : at + 46 + n_name + n_extra]
            field = 0
            while field + 4 <= len(extra):
                kind, width = struct.unpack_from("<HH", extra, field)
                if kind == 1:
                    # Only the values that are marked above are here, in this order.
                    wide = iter(struct.unpack_from(f"<{width // 8}Q", extra, field + 4))
                    size = next(wide) if size == MARK32 else size
                    packed = next(wide) if packed == MARK32 else packed
                    header = next(wide) if header == MARK32 else header
                field += 4 + width
            found.append(Member(name, method, packed, size, header))
            at += 46 + n_name + n_extra + n_comment
        return found

    def data_start(self, member: Member) -> int:
        header = self.read(member.header, LOCAL_BYTES)
        if header[:4] != LOCAL:
            raise ValueError(f"local header of {member.name} missing")
        n_name, n_extra = struct.unpack_from("<HH", header, 26)
        return member.header + LOCAL_BYTES + n_name + n_extra

    def content(self, member: Member) -> bytes:
        """A whole member; for indexes, which may be deflated."""
        data = self.read(self.data_start(member), member.packed)
        if member.method == STORED:
            return data
        if member.method == DEFLATED:
            return zlib.decompress(data, -15)
        raise ValueError(f"{member.name}: method {member.method}")

    def stored_start(self, member: Member) -> int:
        """Where the bytes of a stored member begin, for reading ranges of it."""
        if member.method != STORED:
            raise ValueError(f"{member.name} is not stored: its records can't be read by range")
        return self.data_start(member)
