"""A priority queue of fixed-size records that writes what does not fit to a shared folder."""

from __future__ import annotations

import heapq
import struct
import uuid
from collections.abc import Iterator

from pyarrow import fs

RECORD = struct.Struct("<5q")
CHUNK = 1_024


class SpillingQueue:
    """Records of five longs, least first; at most ``limit`` of them in memory.

    When it is full, the later half goes to a sorted run below ``folder`` (a URI that outlives
    the executor's own disk); runs are merged with what is in memory as records are taken. A
    run is deleted when it has been read, all of them on ``close``.
    """

    def __init__(self, folder: str, limit: int = 1 << 17):
        self.folder, self.limit = folder, max(2, limit)
        self.heap: list[tuple] = []
        self.fronts: list[tuple] = []  # (first record, run number) of each run
        self.runs: dict[int, Iterator[tuple]] = {}
        self.open: dict[int, tuple] = {}
        self.files, self.root, self.spilled = None, "", 0

    def push(self, record: tuple) -> None:
        heapq.heappush(self.heap, record)
        if len(self.heap) > self.limit:
            self._spill()

    def least(self) -> tuple | None:
        """The least record, which stays."""
        if self.fronts and (not self.heap or self.fronts[0][0] < self.heap[0]):
            return self.fronts[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if not self.fronts or (self.heap and self.heap[0] <= self.fronts[0][0]):
            return heapq.heappop(self.heap)
        record, run = self.fronts[0]
        following = next(self.runs[run], None)
        if following is None:
            heapq.heappop(self.fronts)
            self._drop(run)
        else:
            heapq.heapreplace(self.fronts, (following, run))
        return record

    def _spill(self) -> None:
        self.heap.sort()
        half = len(self.heap) // 2
        later, self.heap = self.heap[half:], self.heap[:half]  # a sorted list is a heap
        if self.files is None:
            self.files, self.root = fs.FileSystem.from_uri(self.folder)
            self.files.create_dir(self.root, recursive=True)
        run, path = self.spilled, f"{self.root}/{uuid.uuid4().hex}"
        with self.files.open_output_stream(path, compression=None) as out:
            for k in range(0, len(later), CHUNK):
                out.write(b"".join(RECORD.pack(*r) for r in later[k : k + CHUNK]))
        source = self.files.open_input_stream(path, compression=None)
        self.open[run] = source, path
        self.runs[run] = self._records(source)
        heapq.heappush(self.fronts, (next(self.runs[run]), run))
        self.spilled += 1

    @staticmethod
    def _records(source) -> Iterator[tuple]:
        while data := source.read(CHUNK * RECORD.size):
            yield from RECORD.iter_unpack(data)

    def _drop(self, run: int) -> None:
        source, path = self.open.pop(run)
        source.close()
        self.files.delete_file(path)
        del self.runs[run]

    def close(self) -> None:
        for run in list(self.open):
            self._drop(run)
        self.heap, self.fronts = [], []
