"""Token ids in shuffled planes.

A chunk holds ids in blocks of a fixed size. Every block is transposed, so that the
first bytes (or bits) of its ids stand together, then the second ones and so on; the
planes of all blocks of a chunk are compressed with zstandard, each alone. The high
planes of small ids are all zero and take no room.

The table a shard is written to has one row per chunk and one per document: the chunk
index says where a chunk's ids begin and how many there are, the document index where
a document's do. Spark reads and writes it wherever it can reach.
"""

from __future__ import annotations

import struct
import sys
import types
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm import ragged
from tagloom.llm.common import written

MAGIC = b"PLN1"
HEADER = "<4sBIII"  # magic, planes to an id, ids, ids in a block, planes
LAYOUT = "shard int, chunk int, first long, ids int, payload binary, doc_id long, row long, n_tokens long"
CACHE = 200_000
# Characters of a text that help to deal rows of one id
BEGIN = 32
# Punctuation that no special token and no contraction of the tokenizer's pattern holds.
PLAIN_SIGNS = b'.,!?%$&*#;:()"-_/=+@[]{}~^`'


def tokenizer(path: str) -> tuple:
    """The tokenizer of a file and what is known of its pieces, once per worker process.

    Functions sent to the workers bring globals of their own to every task, so what tasks
    share is kept in a module that only the worker process has.
    """
    import tokenizers

    kept = sys.modules.setdefault("_tagloom_tokenizers", types.ModuleType("_tagloom_tokenizers")).__dict__
    if path not in kept:
        kept[path] = (tokenizers.Tokenizer.from_file(path), {}, _byte_letters())
    return kept[path]


def _byte_letters() -> dict[int, str]:
    """How a byte-level vocabulary writes bytes: printable ones of Latin-1 as they are, the
    others as the letters from 256 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [x for x in range(256) if x not in shown]
    return {x: chr(256 + i) for i, x in enumerate(rest)}


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts can be cut without changing their tokens.

    A byte-level tokenizer splits a text by a pattern first: runs of letters, of digits,
    of other signs, each with a space before it, and white space. So a text can be cut
    before a single space or line end between two other characters, and between ASCII
    letters or digits and plain signs. Neighbours that may belong to a wider white space
    of Unicode don't count.
    """
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 2:
        kind = np.zeros(256, np.uint8)  # 1 white space, 2 letter or digit, 4 sign, 8 start of a wide space
        kind[[*range(9, 14), *range(28, 33)]] = 1
        kind[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 2
        kind[list(PLAIN_SIGNS)] = 4
        kind[[0xC2, 0xE1, 0xE2, 0xE3]] = 8
        k = kind[data]
        mid = (data[1:-1] == 32) | (data[1:-1] == 10)
        mid &= k[:-2] != 1
        mid &= (k[2:] & 9) == 0
        mid[1:] &= k[:-3] != 8
        mid[2:] &= k[:-4] != 8
        cut[1 : n - 1] = mid
        cut[1:n] |= (k[:-1] | k[1:]) == 6
    cut[offsets] = True
    return np.flatnonzero(cut)


def _encoded(pieces: list[bytes], tok, letters: dict[int, str]) -> list[list[int]]:
    """Ids of pieces. Those of letters alone are one unit of the tokenizer's pattern and go
    to its model at once; the others take the whole way."""
    out: list = [None] * len(pieces)
    model, other = tok.model, []
    for i, piece in enumerate(pieces):
        text = piece.decode()
        if (text[1:] if text[0] == " " else text).isalpha():
            # only the space of an ASCII piece is written otherwise
            shown = text.replace(" ", letters[32]) if piece.isascii() else piece.decode("latin-1").translate(letters)
            out[i] = [t.id for t in model.tokenize(shown)]
        else:
            other.append(i)
    full = tok.encode_batch_fast([pieces[i].decode() for i in other], add_special_tokens=False)
    for i, x in zip(other, full):
        out[i] = x.ids
    return out


def encode(data: np.ndarray, offsets: np.ndarray, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, each with the end id, and their counts.

    Pieces are told apart by a hash and then by their bytes; each different one is encoded
    once, and the first ``CACHE`` are remembered.
    """
    tok, known, letters = tokenizer(path)
    cuts = _cuts(data, offsets)
    starts, ends = cuts[:-1], cuts[1:]
    n_docs = len(offsets) - 1
    if not len(starts):
        return np.full(n_docs, end_id, np.uint32), np.ones(n_docs, np.int64)
    _, at, back = np.unique(ragged.byte_hashes(data, starts, ends), return_index=True, return_inverse=True)
    # a piece that shares its hash with another one stands for itself
    odd = np.flatnonzero(~ragged.same_bytes(data, starts, ends, at[back]))
    back[odd] = len(at) + np.arange(len(odd))
    at = np.concatenate((at, odd))
    raw = data.tobytes()
    pieces = [raw[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist())]
    lists = list(map(known.get, pieces))
    missing = [i for i, x in enumerate(lists) if x is None]
    new = [pieces[i] for i in missing]
    fresh = _encoded(new, tok, letters)
    for i, x in zip(missing, fresh):
        lists[i] = x
    known.update(zip(new[: max(0, CACHE - len(known))], fresh))
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum()))
    where = np.cumsum(sizes) - sizes
    counts = sizes[back]
    ids = ragged.gather(flat, where[back], counts)
    # tokens before each text, then room for one end id behind it
    total = np.concatenate(([0], np.cumsum(counts)))
    edges = total[np.searchsorted(cuts, offsets)]
    per_doc = np.diff(edges)
    out = np.empty(len(ids) + n_docs, np.uint32)
    last = np.cumsum(per_doc + 1) - 1
    body = np.ones(len(out), bool)
    body[last] = False
    out[body], out[last] = ids, end_id
    return out, per_doc + 1


def shuffled(ids: np.ndarray, block: int = 4096, bits: bool = False, level: int = 3) -> bytes:
    """One chunk: header, length of every plane, planes."""
    import zstandard

    n = len(ids)
    padded = np.zeros(-(-n // block) * block, "<u4")
    padded[:n] = ids
    planes = 32 if bits else 4
    cells = padded.view(np.uint8).reshape(-1, block, 4)
    if bits:
        cells = np.unpackbits(cells, axis=2, bitorder="little")
    packer = zstandard.ZstdCompressor(level=level)
    out = []
    for i in range(planes):
        plane = np.ascontiguousarray(cells[:, :, i])
        if bits:
            plane = np.packbits(plane, axis=1, bitorder="little")
        out.append(packer.compress(plane.tobytes()) if plane.any() else b"")
    head = struct.pack(HEADER, MAGIC, bits, n, block, planes)
    return head + struct.pack(f"<{planes}I", *map(len, out)) + b"".join(out)


def restored(chunk: bytes) -> np.ndarray:
    """The ids of a chunk."""
    import zstandard

    magic, bits, n, block, planes = struct.unpack_from(HEADER, chunk)
    if magic != MAGIC:
        raise ValueError("not a chunk of planes")
    sizes = struct.unpack_from(f"<{planes}I", chunk, struct.calcsize(HEADER))
    at, blocks = struct.calcsize(HEADER) + 4 * planes, -(-n // block)
    unpack = zstandard.ZstdDecompressor()
    width = -(-block // 8) if bits else block
    cells = np.zeros((planes, blocks, width), np.uint8)
    for i, size in enumerate(sizes):
        if size:
            cells[i] = np.frombuffer(unpack.decompress(chunk[at : at + size]), np.uint8).reshape(blocks, width)
        at += size
    if bits:
        cells = np.unpackbits(cells, axis=2, count=block, bitorder="little")
        cells = np.packbits(cells, axis=0, bitorder="little")
    return np.ascontiguousarray(cells.transpose(1, 2, 0)).view("<u4").reshape(-1)[:n]


def write_ids(
    docs: DataFrame,
    path: str,
    *,
    id_col: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    shard_bytes: int = 16 << 20,
    chunk_ids: int = 1 << 16,
    block: int = 4096,
    bits: bool = False,
    work_bytes: int = 2 << 20,
) -> DataFrame:
    """The ids of all texts, in ascending order of id, in the table described above.

    ``path`` names the tokenizer's file, which every worker can read. Shards are ranges
    of ids of about ``shard_bytes`` of text, chunks hold ``chunk_ids`` ids, and a worker
    tokenises ``work_bytes`` of text, or one longer text, at a time. Null texts count as
    empty: the end id alone. Null ids come first; repeated ids keep one row each, in the
    order of their texts. An empty table gives an empty one; other columns are not read.
    """
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    shards = 1 + size // shard_bytes
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    # many rows may have one id, or none: by their beginnings a range can end among them
    begin = F.substring("text", 1, BEGIN)
    ordered = rows.repartitionByRange(shards, "doc_id", begin).sortWithinPartitions("doc_id", "text")

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        schema = pa.schema(
            [("shard", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("ids", pa.int32()),
             ("payload", pa.binary()), ("doc_id", pa.int64()), ("row", pa.int64()), ("n_tokens", pa.int64())]
        )
        pending, done, chunk, row = np.zeros(0, np.uint32), 0, 0, 0

        def packed(ids: np.ndarray) -> pa.RecordBatch:
            values = (number, chunk, done, len(ids), shuffled(ids, block, bits), None, None, None)
            return pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(values, schema)], schema=schema)

        for batch in batches:
            for part in ragged.portions(batch, "text", work_bytes):
                ids, counts = encode(*ragged.joined(part["text"]), path, end_id)
                n, before = len(counts), np.cumsum(counts) - counts + done + len(pending)
                empty = [pa.nulls(n, t.type) for t in schema]
                empty[0] = pa.array(np.full(n, number, np.int32))
                empty[2], empty[5] = pa.array(before), part["doc_id"]
                empty[6], empty[7] = pa.array(np.arange(row, row + n)), pa.array(counts)
                yield pa.RecordBatch.from_arrays(empty, schema=schema)
                row += n
                pending = np.concatenate((pending, ids))
                while len(pending) >= chunk_ids:
                    yield packed(pending[:chunk_ids])
                    pending, done, chunk = pending[chunk_ids:], done + chunk_ids, chunk + 1
        if len(pending):
            yield packed(pending)

    return written(ordered.mapInArrow(shard, LAYOUT), "token-ids")


def read_ids(stored: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the written planes.

    ``start`` counts the ids of all documents before, in the order of the file.
    """
    totals = stored.filter("payload is not null").groupBy("shard").agg(F.sum("ids").alias("_ids"))
    # one row a shard
    base = totals.select("shard", (F.sum("_ids").over(Window.orderBy("shard")) - F.col("_ids")).alias("_base"))
    chunks = stored.filter("payload is not null").select("shard", "chunk", "payload")
    index = stored.filter("payload is null").select("shard", "doc_id", "row", "first", "n_tokens")

    def checked(docs: pa.Table, parts: pa.Table) -> pa.Table:
        ids = [restored(c) for c in parts.sort_by("chunk")["payload"].to_pylist()]
        raw = memoryview(np.concatenate(ids or [np.zeros(0, "<u4")]).astype("<u4")).cast("B")
        first, n = docs["first"].to_numpy(), docs["n_tokens"].to_numpy()
        crc = [zlib.crc32(raw[4 * a : 4 * (a + c)]) for a, c in zip(first.tolist(), n.tolist())]
        return pa.table(
            {"shard": docs["shard"], "doc_id": docs["doc_id"], "first": docs["first"], "n_tokens": docs["n_tokens"],
             "ids_crc32": pa.array(crc, pa.int64())}
        )

    back = (
        index.groupBy("shard")
        .cogroup(chunks.groupBy("shard"))
        .applyInArrow(checked, "shard int, doc_id long, first long, n_tokens long, ids_crc32 long")
    )
    return back.join(base, "shard").select("doc_id", (F.col("_base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
