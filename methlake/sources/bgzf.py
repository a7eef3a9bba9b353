"""Blocked gzip: blocks of at most 64 KiB that are found and checked from any place in a file."""

from __future__ import annotations

import struct
import zlib

MAGIC = b"\x1f\x8b\x08\x04"
#: the empty block that ends a whole file (a fixed value of the format)
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
#: data bytes of a block, which must fit in 64 KiB even where they do not shrink
BLOCK = 65280


class Broken(ValueError):
    """A file that is cut off or damaged."""


def block(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    return MAGIC + struct.pack("<IBBHBBHH", 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def block_size(head: bytes, at: int) -> int | None:
    """Bytes of the block whose header starts at a place, or None if none does."""
    if head[at : at + 4] != MAGIC or len(head) < at + 12:
        return None
    end = at + 12 + struct.unpack_from("<H", head, at + 10)[0]
    at += 12
    while at + 4 <= min(end, len(head)):
        a, b, n = struct.unpack_from("<BBH", head, at)
        if (a, b, n) == (66, 67, 2) and at + 6 <= len(head):
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + n
    return None


def unpacked(raw: bytes) -> bytes:
    """The data of one block; Broken if its checksum or length does not agree."""
    extra = struct.unpack_from("<H", raw, 10)[0]
    check, size = struct.unpack_from("<II", raw, len(raw) - 8)
    try:
        data = zlib.decompress(raw[12 + extra : -8], -15, BLOCK)
    except zlib.error as e:
        raise Broken(str(e)) from e
    if len(data) != size or zlib.crc32(data) != check:
        raise Broken("checksum of a block")
    return data


class Blocks:
    """Blocks of a file one after another from an address on."""

    def __init__(self, fs, path: str, size: int, address: int = 0, step: int = 1 << 22):
        self.file, self.path, self.size, self.step = fs.open_input_file(path), path, size, step
        self.address, self.base, self.held = address, address, b""

    def __enter__(self) -> Blocks:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()

    def _bytes(self, n: int) -> bytes:
        """At least n bytes from the address on, fewer only at the end of the file."""
        at = self.address - self.base
        if at + n > len(self.held) and self.base + len(self.held) < self.size:
            self.held, self.base, at = self.held[at:], self.address, 0
            self.held += self.file.read_at(max(self.step, n - len(self.held)), self.base + len(self.held))
        return self.held[at : at + n]

    def next(self) -> tuple[int, bytes] | None:
        """(address, data) of the next block; None at the end of the file."""
        if self.address >= self.size:
            return None
        head = self._bytes(1 << 16)
        n = block_size(head, 0)
        if n is None or n < 26:
            raise Broken(f"{self.path}: no block at {self.address}")
        if len(head) < n:
            raise Broken(f"{self.path}: cut off inside the block at {self.address}")
        at = self.address
        try:
            data = unpacked(head[:n])
        except Broken as e:
            raise Broken(f"{self.path}: {e} at {at}") from e
        self.address += n
        return at, data

    def seek(self) -> bool:
        """Moves on to the first place that is a whole block; False if there is none."""
        while self.address < self.size:
            head = self._bytes(self.step)
            at = head.find(MAGIC)
            if at < 0:
                self.address += max(1, len(head) - 3)
                continue
            self.address += at
            raw = self._bytes(1 << 16)
            n = block_size(raw, 0)
            if n is not None and 26 <= n <= len(raw):
                try:
                    unpacked(raw[:n])
                    return True
                except Broken:
                    pass
            self.address += 1
        return False
