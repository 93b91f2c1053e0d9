"""Range reads from ZIP packages: the central directory, also in its 64-bit form, and the places of stored members."""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

# Fixed values of the ZIP format.
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
FULL16, FULL32, STORED, DEFLATED, EXTRA64 = 0xFFFF, 0xFFFFFFFF, 0, 8, 1


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header: int


def read_range(file, start: int, length: int) -> bytes:
    """Exactly the bytes asked for, from a file that can seek."""
    file.seek(start)
    data = file.read(length)
    if len(data) != length:
        raise ValueError(f"archive ends early: {length} bytes wanted at {start}")
    return data


def directory(file, size: int) -> dict[str, Member]:
    """The members of a package by name, from its tail and central directory alone."""
    tail_start = max(0, size - 22 - FULL16)
    tail = read_range(file, tail_start, size - tail_start)
    at = tail.rfind(END)
    # The true one is followed by a comment that ends with the file; the comment may hold the signature.
    while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if count == FULL16 or length == FULL32 or start == FULL32:
        locator = tail.rfind(LOCATOR64, 0, at)
        if locator < 0:
            raise ValueError("no 64-bit end of central directory")
        record = read_range(file, struct.unpack_from("<Q", tail, locator + 8)[0], 56)
        if record[:4] != END64:
            raise ValueError("broken 64-bit end of central directory")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
    data = read_range(file, start, length)
    found, here = {}, 0
    for _ in range(count):
        if data[here : here + 4] != ENTRY:
            raise ValueError("broken central directory")
        method = struct.unpack_from("<H", data, here + 10)[0]
        packed, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", data, here + 20)
        header = struct.unpack_from("<I", data, here + 42)[0]
        name = data[here + 46 : here + 46 + n_name].decode()
        extra = data[here + 46 + n_name : here + 46 + n_name + n_extra]
        field = 0
        while field + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, field)
            if kind == EXTRA64:
                # Only the numbers that do not fit stand here, in this order: full size, packed size, header.
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, field + 4))
                full = next(wide) if full == FULL32 else full
                packed = next(wide) if packed == FULL32 else packed
                header = next(wide) if header == FULL32 else header
            field += 4 + n
        found[name] = Member(name, method, packed, header)
        here += 46 + n_name + n_extra + n_comment
    return found


def _start(file, member: Member) -> int:
    head = read_range(file, member.header, 30)
    if head[:4] != LOCAL:
        raise ValueError(f"no local header for {member.name}")
    return member.header + 30 + sum(struct.unpack_from("<HH", head, 26))


def data_start(file, member: Member) -> int:
    """Where a stored member's bytes begin."""
    if member.method != STORED:
        raise ValueError(f"{member.name} is compressed; its records can't be read by range")
    return _start(file, member)


def content(file, member: Member) -> bytes:
    """A whole member, stored or compressed."""
    data = read_range(file, _start(file, member), member.size)
    if member.method == DEFLATED:
        return zlib.decompress(data, -15)
    if member.method != STORED:
        raise ValueError(f"{member.name} is packed by method {member.method}")
    return data
