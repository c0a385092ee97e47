"""The bucket steps of operator 7 on Arrow batches, for callers that hold batches instead of DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

from tidemark.llm.bpe import ranges

#: rows of bands that a task gathers before it sends them on
BAND_ROWS = 2_000_000


def _halves(line: bytes) -> tuple[int, int]:
    """The two halves of the 128 bits by which lines are equal, as signed 64-bit numbers."""
    h = xxhash.xxh3_128_intdigest(line)
    return (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63)


_BUCKET = pa.schema([("band", pa.int64()), ("id", pa.int64()), ("a", pa.int64()), ("hub", pa.bool_())])


def _groups(band: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(band, id, smallest id of the band, members of the band), ordered by band and id."""
    o = np.lexsort((ids, band))
    band, ids = band[o], ids[o]
    first = np.flatnonzero(np.append(True, band[1:] != band[:-1])[:len(band)])
    size = np.diff(np.append(first, len(band)))
    return band, ids, np.repeat(ids[first], size), np.repeat(size, size)


def _local_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, bands) -> rows by band; of the members that one task holds of a bucket only the first has no hub yet."""
    held: list[tuple] = []

    def rows():
        ids, flat = (np.concatenate(x) for x in zip(*held, strict=True))
        band, ids, low, size = _groups(flat, ids)
        first = ids == low
        return pa.RecordBatch.from_arrays([pa.array(band), pa.array(ids), pa.array(low, mask=first), pa.array(first & (size > 1))],
                                          schema=_BUCKET)
    for batch in batches:
        lists = batch.column(1)
        size = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        # the same value in another band is another bucket
        number = ranges(np.zeros_like(size), size)
        value = lists.flatten().to_numpy().astype(np.int64) & 0xFFFFFFFF
        held.append((np.repeat(batch.column(0).to_numpy(), size), number << 32 | value))
        if sum(len(i) for i, _ in held) > BAND_ROWS:
            yield rows()
            held = []
    if held:
        yield rows()


def _joined_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows without a hub come first, by band and id: they get their band's smallest id, and those alone in theirs go."""
    open_band = open_low = None
    waits = False  # the first row of the open band has met no other yet
    stays = False  # ... but has members in its own task
    for batch in batches:
        done = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
        band, ids, hub = (batch.column(k).to_numpy(zero_copy_only=False)[~done] for k in (0, 1, 3))
        out = [batch.filter(pa.array(done))]
        if len(band):
            new = np.append(True, band[1:] != band[:-1])
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(band)))
            low = np.repeat(ids[first], size)
            keep = np.repeat(size > 1, size) | hub
            goes_on = open_band == band[0]
            if goes_on:
                low[:size[0]], keep[:size[0]] = open_low, True
            if waits and (goes_on or stays):
                out.append(_bucket_rows([open_band], [open_low], [open_low]))
            # the last band may go on in the next batch: a single row of it waits
            waits = bool(size[-1] == 1 and not (goes_on and len(first) == 1))
            open_band, open_low, stays = int(band[-1]), int(low[-1]), bool(hub[-1])
            if waits:
                keep[-1] = False
            out.append(_bucket_rows(band[keep], ids[keep], low[keep]))
        yield from (x for x in out if x.num_rows)
    if waits and stays:
        yield _bucket_rows([open_band], [open_low], [open_low])


def _bucket_rows(band, ids, low) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(band, pa.int64()), pa.array(ids, pa.int64()), pa.array(low, pa.int64()),
                                       pa.array(np.zeros(len(band), dtype=bool))], schema=_BUCKET)
