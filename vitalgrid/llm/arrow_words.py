"""Words of whole texts as flat Arrow arrays, batch by batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: What stands between words of ASCII letters, digits and all other characters, after capitals went.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def slices(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose texts take about ``most`` bytes; a longer text is a run of its own."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(size) // most
    cut = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cut, cut[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Place of each word's text in ``texts`` and the words, A-Z lower-cased; a null text has none."""
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), pattern=BETWEEN)
    flat, row = lists.flatten(), pc.list_parent_indices(lists)
    held = pc.greater(pc.binary_length(flat), 0)
    return row.filter(held).to_numpy(), flat.filter(held)
