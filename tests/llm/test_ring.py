"""Placement on the ring row by row, and how many rows another shard moves."""

from __future__ import annotations

import struct
from bisect import bisect_left
from collections import defaultdict, deque

import pytest
import xxhash

from framestore.llm.sharding import CELL_BITS, shard


def h64(*values, seed=42):
    """The hash of Spark: each value is hashed with the hash before it as the seed."""
    for v in values:
        seed = xxhash.xxh64_intdigest(v, seed)
    return seed


def plain(ids, shards, vnodes=64):
    """(id, home, shard, slot) of rows in the order of their numbers."""
    owner = {}
    for s in range(shards):
        for v in range(vnodes):
            cell = h64(b"node", struct.pack("<i", s), struct.pack("<q", v)) >> (64 - CELL_BITS)
            owner[cell] = min(s, owner.get(cell, shards))
    places = sorted(owner)
    arcs = defaultdict(list)
    for row, i in enumerate(ids):
        h = h64(struct.pack("<q", i)) if i is not None else h64(b"row", struct.pack("<q", row))
        arcs[bisect_left(places, h >> (64 - CELL_BITS)) % len(places)].append((h - (1 << 64) if h >> 63 else h, row, i))
    home_of = [owner[p] for p in places]
    share = [len(ids) // shards + (s < len(ids) % shards) for s in range(shards)]
    own = [sum(len(rows) for a, rows in arcs.items() if home_of[a] == s) for s in range(shards)]
    stays = [min(a, b) for a, b in zip(own, share)]
    room = [a - b for a, b in zip(share, stays)]
    slots, out, waiting = [0] * shards, [], deque()

    def put(row, home, s):
        out.append((row[2], home, s, slots[s]))
        slots[s] += 1

    for lap in range(2):
        for a, s in enumerate(home_of):
            while waiting and room[s]:
                put(*waiting.popleft(), s)
                room[s] -= 1
            for row in sorted(arcs[a]) if lap == 0 else ():
                if stays[s]:
                    stays[s] -= 1
                    put(row, s, s)
                else:
                    waiting.append((row, s))
    return out


@pytest.mark.parametrize("shards", [8, 3])
def test_rows_go_where_a_walk_around_the_ring_puts_them(spark, shards):
    ids = [*range(0, 3000, 7), *[k**3 for k in range(60)], 5, 5, 5, None, None, -1]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id bigint, text string").coalesce(1)
    got = sorted(((r.doc_id, r.home, r["shard"], r.slot) for r in shard(df, shards).collect()), key=repr)
    assert got == sorted(plain(ids, shards), key=repr)


def test_another_shard_moves_few_rows():
    """At least 1 in 9 rows has to move. Exact shares move some more: what overflows goes on to other shards."""
    ids = list(range(20000))
    before, after = ({i: (home, s) for i, home, s, _ in plain(ids, n)} for n in (8, 9))
    homes = sum(before[i][0] != after[i][0] for i in ids) / len(ids)
    moved = sum(before[i][1] != after[i][1] for i in ids) / len(ids)
    assert all(after[i][0] in (8, before[i][0]) for i in ids)  # the ring itself only gives to the new shard
    print(f"homes {homes:.3f}, rows {moved:.3f}")
    assert homes < 0.2 and moved < 0.35
