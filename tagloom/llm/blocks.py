"""Documents in blocks, and sets of hashes that meet in bins.

Finding what repeats across a corpus needs every window's hash at one place, but not a
row for each. Documents are dealt into blocks by their id. A block hashes all its
windows and sends every different hash once to one of as many bins, packed together
with the others of that bin. A bin answers each block with one bit a hash. A window
that a third of the corpus holds costs one entry a block, and texts move only once,
compressed, when the blocks are made.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm import ragged

FRAGMENT = "block int, ids binary, sizes binary, texts binary"
NO_ID = -(1 << 63)


@dataclass
class Block:
    """The documents of a block in ascending order of id, a space behind each."""

    number: int
    ids: np.ndarray
    data: np.ndarray
    offsets: np.ndarray


def deal(docs: DataFrame, *, id_col: str, text: str, block_bytes: int) -> tuple[DataFrame, int]:
    """Fragments of all blocks, each block in one partition, and the number of blocks.

    Null texts are empty. Rows without an id get the least id there is and are dealt by
    their text. The frame is kept on the executors' disks; unpersist it when done.
    """
    size = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    n = int(1 + size // block_bytes)
    key = F.coalesce(F.xxhash64(F.col(id_col)), F.xxhash64(F.col(text)))
    rows = docs.select(
        F.pmod(F.when(F.col(id_col).isNull(), F.xxhash64(F.col(text))).otherwise(key), F.lit(n)).cast("int").alias("block"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            blocks, ids = batch["block"].to_numpy(), batch["id"].to_numpy()
            data, offsets = ragged.joined(batch["text"])
            order = np.argsort(blocks, kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(blocks[order])) + 1):
                if len(some):
                    sizes = np.diff(offsets)[some]
                    texts = packer.compress(b"".join(data[a : a + m] for a, m in zip(offsets[some], sizes)))
                    values = [[int(blocks[some[0]])], [ids[some].tobytes()], [sizes.tobytes()], [texts]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, t) for v, t in zip(values, (pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                        names=["block", "ids", "sizes", "texts"],
                    )

    dealt = rows.mapInArrow(fragments, FRAGMENT).repartition(n, "block")
    return dealt.persist(StorageLevel.DISK_ONLY), n


def load(fragments: pa.Table) -> Block:
    """The whole block of its fragments."""
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    ids = np.frombuffer(b"".join(fragments["ids"].to_pylist()), np.int64)
    sizes = np.frombuffer(b"".join(fragments["sizes"].to_pylist()), np.int64)
    data = b"".join(unpack.decompress(x) for x in fragments["texts"].to_pylist())
    ends = np.cumsum(sizes)
    texts = [data[e - m : e] for e, m in zip(ends.tolist(), sizes.tolist())]
    order = np.argsort(ids, kind="stable")
    if (np.diff(ids[order]) == 0).any():  # rows of one id stand in the order of their texts, however they arrived
        order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i], texts[i])))
    offsets = np.concatenate(([0], np.cumsum(sizes[order] + 1)))
    whole = np.frombuffer(b" ".join([*(texts[i] for i in order), b""]), np.uint8)
    return Block(fragments["block"][0].as_py(), ids[order], whole, offsets)


def packed_low(hashes: np.ndarray) -> bytes:
    """The low 40 bits of hashes that share a bin: the bin's number stands for the others."""
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def low(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(packed, np.uint8).reshape(-1, 5)
    return out.view("<u8").reshape(-1)


def in_bins(hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of hashes by bin, and where each bin that has some begins and which it is."""
    bins = ((hashes >> np.uint64(40)) % np.uint64(n)).astype(np.int64)
    order = np.argsort(bins, kind="stable")
    edges = np.flatnonzero(np.concatenate(([True], np.diff(bins[order]) != 0))) if len(order) else order
    return order, edges, bins[order][edges]


def cells(hashes: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bin, positions of its hashes), in the order that ``answers`` gives them back."""
    order, edges, bins = in_bins(hashes, n)
    for some, number in zip(np.split(order, edges[1:]) if len(edges) else [], bins.tolist()):
        yield number, some


def answers(hashes: np.ndarray, n: int, flags: dict[int, bytes]) -> np.ndarray:
    """One bool a hash, from the bits of each bin."""
    out = np.zeros(len(hashes), bool)
    for number, some in cells(hashes, n):
        if number in flags:
            out[some] = np.unpackbits(np.frombuffer(flags[number], np.uint8), count=len(some)).astype(bool)
    return out


def in_several(sent: pa.Table) -> Iterator[tuple[int, bytes, int]]:
    """For every block of a bin: which of its hashes another block sent as well."""
    lists = [low(x) for x in sent["hashes"].to_pylist()]
    sizes = np.array([len(x) for x in lists])
    _, back, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    some = times[back] > 1
    for number, bits in zip(sent["block"].to_pylist(), np.split(some, np.cumsum(sizes)[:-1])):
        if bits.any():
            yield number, np.packbits(bits).tobytes(), int(bits.sum())


def owned_first(sent: pa.Table) -> Iterator[tuple[int, bytes, int]]:
    """For every block of a bin: which of its hashes a block with a smaller document has.

    Hashes come whole here, each with the block's smallest document that holds it; rows
    without an id rank by their block.
    """
    lists = [np.frombuffer(x, "<u8") for x in sent["hashes"].to_pylist()]
    sizes = np.array([len(x) for x in lists])
    docs = np.concatenate([np.frombuffer(x, "<i8") for x in sent["docs"].to_pylist()])
    numbers = sent["block"].to_numpy()
    _, back = np.unique(np.concatenate(lists), return_inverse=True)
    place = np.repeat(numbers.astype(np.int64), sizes)
    order = np.lexsort((place, docs, back))
    heads = order[np.concatenate(([True], np.diff(back[order]) != 0))]
    owner = place[heads][back]
    for number, bits in zip(numbers.tolist(), np.split(owner != place, np.cumsum(sizes)[:-1])):
        if bits.any():
            yield number, np.packbits(bits).tobytes(), int(bits.sum())


ANSWER = "block int, bin int, bits binary, n long"


def ask(sent: DataFrame, judge: Callable[[pa.Table], Iterator[tuple[int, bytes, int]]]) -> DataFrame:
    """Every bin judges what the blocks sent it."""

    def one(table: pa.Table) -> pa.Table:
        rows = list(judge(table)) if table.num_rows else []
        number = table["bin"][0].as_py()
        return pa.table(
            {
                "block": pa.array([r[0] for r in rows], pa.int32()),
                "bin": pa.array([number] * len(rows), pa.int32()),
                "bits": pa.array([r[1] for r in rows], pa.binary()),
                "n": pa.array([r[2] for r in rows], pa.int64()),
            }
        )

    return sent.groupBy("bin").applyInArrow(one, ANSWER)


def bits_of(flags: pa.Table) -> dict[int, bytes]:
    return dict(zip(flags["bin"].to_pylist(), flags["bits"].to_pylist()))
