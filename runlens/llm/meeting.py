"""Owners that share a hash, found with a packed shuffle.

Hashes go to buckets as packed arrays, one row for each bucket and batch instead of
one for each hash, and are sorted in numpy where they meet. Only the distinct lists
of owners that share some hash go on.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_U8 = np.dtype("<u8")

# Hashes in a bucket on average.
BUCKET = 1 << 20


def lists_of(
    rows: DataFrame,
    start: Callable[[], Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]],
    expected: int,
    marked: bool = False,
) -> DataFrame:
    """(members) of every distinct list of two or more owners that share a hash.

    `start`, called once in each task, gives a function that makes the hashes of a batch
    and the owner of each, both 64-bit; `expected` is about how many there are. If `marked`, the lowest bit of an owner is a mark and
    not part of it, and only lists with a marked owner count. Members are packed, in
    ascending order. Callers keep hashes that a large share of owners has out of it.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * partitions, math.ceil(expected / BUCKET))

    def deal(batches):
        hashed = start()
        for batch in batches:
            hashes, owners = hashed(batch)
            to = (hashes % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            to, hashes, owners = to[order], hashes[order], owners[order]
            used, starts = np.unique(to, return_index=True)
            edges = list(zip(starts, [*starts[1:], len(to)], strict=False))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(used, pa.int64()),
                    pa.array([hashes[i:j].tobytes() for i, j in edges], pa.binary()),
                    pa.array([owners[i:j].tobytes() for i, j in edges], pa.binary()),
                ],
                names=["bucket", "hashes", "owners"],
            )

    def meet(table: pa.Table) -> pa.Table:
        hashes = np.frombuffer(b"".join(x.as_py() for x in table.column("hashes")), _U8)
        owners = np.frombuffer(b"".join(x.as_py() for x in table.column("owners")), _U8)
        order = np.lexsort((owners, hashes))
        hashes, owners = hashes[order], owners[order]
        plain = owners & ~np.uint64(1) if marked else owners
        new_hash = np.concatenate([[True], hashes[1:] != hashes[:-1]])
        # The last entry of an owner for a hash is the marked one, if there is one.
        last = np.concatenate([new_hash[1:] | (plain[1:] != plain[:-1]), [True]])
        hashes, owners, plain = hashes[last], owners[last], plain[last]
        starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        many = np.diff(np.concatenate([starts, [len(hashes)]])) > 1
        if marked:
            many &= np.bitwise_or.reduceat(owners & np.uint64(1), starts).astype(bool)
        ends = np.concatenate([starts[1:], [len(hashes)]])
        lists = {plain[i:j].tobytes() for i, j in zip(starts[many], ends[many], strict=True)}
        return pa.table({"members": pa.array(sorted(lists), pa.binary())})

    dealt = rows.mapInArrow(deal, "bucket long, hashes binary, owners binary")
    return dealt.groupBy("bucket").applyInArrow(meet, "members binary").distinct()


def unpacked(lists: DataFrame) -> DataFrame:
    """(gid, member) of every member of every list; `lists` has gid and members."""

    def run(batches):
        for batch in batches:
            found = [np.frombuffer(x, np.int64) for x in batch.column("members").to_pylist()]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(batch.column("gid").to_numpy(), [len(x) for x in found])),
                        pa.array(np.concatenate(found)),
                    ],
                    names=["gid", "member"],
                )

    return lists.mapInArrow(run, "gid long, member long")
