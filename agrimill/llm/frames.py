"""Texts as independent zstandard frames with cumulative unit counts, so that any stretch is read without the rest."""

from __future__ import annotations

import bisect
import hashlib
import threading
from collections.abc import Iterable, Iterator

import zstandard

# Code points of a frame, and the compression level.
UNITS, LEVEL = 16_384, 1
_own = threading.local()


def pack(text: str) -> bytes:
    if not hasattr(_own, "packer"):
        _own.packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
    return _own.packer.compress(text.encode())


def unpack(frame: bytes) -> bytes:
    if not hasattr(_own, "unpacker"):
        _own.unpacker = zstandard.ZstdDecompressor()
    return _own.unpacker.decompress(frame)


class Framed:
    """One text: its frames in order, and the units (code points) up to the end of each."""

    def __init__(self, frames: list[bytes] | None = None, ends: list[int] | None = None):
        self.frames, self.ends = list(frames or []), list(ends or [])

    @classmethod
    def of(cls, text: str, units: int = UNITS) -> Framed:
        made = cls()
        for at in range(0, len(text), units):
            made.write(text[at:at + units])
        return made

    def __len__(self) -> int:
        return self.ends[-1] if self.ends else 0

    def write(self, text: str) -> None:
        """Add a text as a frame of its own; nothing is added for an empty one."""
        if text:
            self.frames.append(pack(text))
            self.ends.append(len(self) + len(text))

    def select(self, start: int, end: int) -> Iterator[tuple[bytes | str, int]]:
        """Units from `start` up to `end`: whole frames as they are stored, cut ones decompressed, each with its units."""
        i = bisect.bisect_right(self.ends, start)
        while start < end:
            first, last = self.ends[i - 1] if i else 0, self.ends[i]
            if start == first and last <= end:
                yield self.frames[i], last - first
            else:
                cut = unpack(self.frames[i]).decode()[start - first:end - first]
                yield cut, len(cut)
            start, i = last, i + 1

    def copy(self, other: Framed, start: int, end: int) -> None:
        """Add units of another text; its whole frames are taken over without being decompressed."""
        for part, units in other.select(start, end):
            if isinstance(part, str):
                self.write(part)
            else:
                self.frames.append(part)
                self.ends.append(len(self) + units)

    def stream(self, start: int = 0, end: int | None = None) -> Iterator[bytes]:
        """UTF-8 of a stretch, in order, a frame at a time."""
        for part, _ in self.select(start, len(self) if end is None else end):
            yield part.encode() if isinstance(part, str) else unpack(part)

    def find(self, marks: Iterable[str]) -> list[int]:
        """Where each of the marks (in order of appearance) is first found after the one before; -1 for one that is not.

        Frames are read one after the other; a mark may lie across frames.
        """
        places, marks = [], list(marks)
        tail, base, at = "", 0, 0
        for data in self.stream():
            window = tail + data.decode()
            while len(places) < len(marks):
                hit = window.find(marks[len(places)], max(0, at - base))
                if hit < 0:
                    break
                places.append(base + hit)
                at = base + hit + len(marks[len(places) - 1])
            if len(places) == len(marks):
                return places
            keep = min(len(window), len(marks[len(places)]) - 1)
            base, tail = base + len(window) - keep, window[len(window) - keep:]
        return places + [-1] * (len(marks) - len(places))


def digest(parts: Iterable[bytes]) -> str:
    h = hashlib.sha256()
    for part in parts:
        h.update(part)
    return h.hexdigest()
