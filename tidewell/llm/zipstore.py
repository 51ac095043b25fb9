"""Range reads from ZIP archives whose members are stored, not compressed.

Only the tail, the central directory and the wanted ranges are read; ZIP64 end
records and extra fields are followed. Files are opened through pyarrow, so a
path may be on any file system it knows (a plain path is local or mounted).
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import pyarrow.fs as pafs

#: fixed values of the ZIP format: signatures
EOCD, EOCD64, LOCATOR64, CENTRAL, LOCAL = (b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07",
                                           b"PK\x01\x02", b"PK\x03\x04")
_FULL32, _FULL16 = 0xFFFFFFFF, 0xFFFF


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        if path.startswith("file:") and not path.startswith("file://"):
            path = "file://" + path[len("file:"):]
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    start: int
    size: int


def read_range(f, start: int, size: int) -> bytes:
    f.seek(start)
    got = f.read(size)
    if len(got) != size:
        raise ValueError(f"archive ends before byte {start + size}")
    return got


def members(f) -> list[Member]:
    """All members of an open archive, with the place of their data."""
    total = f.size()
    tail_size = min(total, 22 + _FULL16 + 20)
    tail = read_range(f, total - tail_size, tail_size)
    at = tail.rfind(EOCD)
    while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(EOCD, 0, at)  # the signature may occur in the comment
    if at < 0:
        raise ValueError("no end of central directory")
    count, size, start = struct.unpack_from("<HII", tail, at + 10)
    if at >= 20 and tail[at - 20:at - 16] == LOCATOR64:
        where = struct.unpack_from("<Q", tail, at - 12)[0]
        record = read_range(f, where, 56)
        if record[:4] != EOCD64:
            raise ValueError("ZIP64 locator points nowhere")
        count, size, start = struct.unpack_from("<QQQ", record, 32)
    directory = read_range(f, start, size)
    found, pos = [], 0
    for _ in range(count):
        if directory[pos:pos + 4] != CENTRAL:
            raise ValueError("broken central directory")
        method = struct.unpack_from("<H", directory, pos + 10)[0]
        packed, plain = struct.unpack_from("<II", directory, pos + 20)
        n, extra, comment = struct.unpack_from("<HHH", directory, pos + 28)
        offset = struct.unpack_from("<I", directory, pos + 42)[0]
        name = directory[pos + 46:pos + 46 + n].decode()
        field, end = pos + 46 + n, pos + 46 + n + extra
        while field + 4 <= end:
            kind, length = struct.unpack_from("<HH", directory, field)
            if kind == 0x0001:  # 64-bit values, in this order, for the fields that are full
                values = iter(struct.unpack_from(f"<{length // 8}Q", directory, field + 4))
                plain = next(values) if plain == _FULL32 else plain
                packed = next(values) if packed == _FULL32 else packed
                offset = next(values) if offset == _FULL32 else offset
            field += 4 + length
        pos = end + comment
        head = read_range(f, offset, 30)
        if head[:4] != LOCAL:
            raise ValueError(f"no local header for {name}")
        skip = sum(struct.unpack_from("<HH", head, 26))
        found.append(Member(name, method, offset + 30 + skip, packed))
    return found
