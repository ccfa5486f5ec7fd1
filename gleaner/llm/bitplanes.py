"""Token ids as bit-plane shuffled, compressed blocks with a chunk index.

The ids of a partition's documents are laid end to end and cut into blocks of
``block`` ids.  A block is transposed into planes (16 or 32 planes of single
bits, or 2 or 4 of bytes), each plane is compressed with zstandard, and the
block's row stores where each plane lies in its payload and which part of which
document lies where in the block.

Null and empty texts, and rows without a doc_id, keep an entry of no ids.
Repeated rows are written as often as they occur.  Long texts run over as many
blocks as they need.  Other columns are ignored; an empty table gives no blocks.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK = 1 << 16
LEVEL = 3

_PART = pa.struct([("doc_id", pa.int64()), ("start", pa.int32()), ("from", pa.int32()), ("length", pa.int32())])
_PLANE = pa.struct([("offset", pa.int32()), ("length", pa.int32())])
_NAMES = ["shard", "block", "n_ids", "id_bytes", "planes", "payload", "documents"]
_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(_PLANE), pa.binary(), pa.list_(_PART)]
SCHEMA = (
    "shard int, block long, n_ids int, id_bytes int, planes array<struct<offset:int,length:int>>, "
    "payload binary, documents array<struct<doc_id:long,start:int,from:int,length:int>>"
)


def load(path: str):
    """A byte-level BPE encoder from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return encoder_of(f.read())


def encoder_of(content: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def to_planes(ids: np.ndarray, bits: bool = True) -> list[bytes]:
    """The planes of an array of uint16 or uint32, least significant first."""
    width = ids.dtype.itemsize
    raw = ids.astype(ids.dtype.newbyteorder("<")).view(np.uint8).reshape(-1, width)
    if not bits:
        return [raw[:, k].tobytes() for k in range(width)]
    cells = np.unpackbits(raw, axis=1, bitorder="little")
    packed = np.packbits(np.ascontiguousarray(cells.T), axis=1, bitorder="little")
    return [p.tobytes() for p in packed]


def from_planes(planes: list[bytes], n: int, width: int) -> np.ndarray:
    """The ids that ``to_planes`` took apart."""
    kind = {2: "<u2", 4: "<u4"}[width]
    if not n:
        return np.zeros(0, dtype=kind)
    if len(planes) == width:
        return np.ascontiguousarray(np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)).view(kind)[:, 0]
    cells = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes], axis=1)
    return np.ascontiguousarray(np.packbits(cells, axis=1, bitorder="little")).view(kind)[:, 0]


def decode(n_ids: int, id_bytes: int, planes, payload: bytes) -> np.ndarray:
    """The ids of a block's row."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    parts = [unpack(payload[o : o + n]) for o, n in planes]
    return from_planes(parts, n_ids, id_bytes)


def blocks(docs: DataFrame, tokenizer: str = TOKENIZER, block: int = BLOCK, bits: bool = True, level: int = LEVEL) -> DataFrame:
    """One row a block: shard and block number, planes, payload and the parts of documents it holds.

    The driver reads the vocabulary (a file of a few MB) and sends it to the executors.
    """
    with open(tokenizer, "rb") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())

    def write(batches):
        import zstandard
        from pyspark import TaskContext

        encoder = encoder_of(vocabulary.value)
        kind = np.dtype("<u2" if encoder.n_vocab <= 1 << 16 else "<u4")
        shrink = zstandard.ZstdCompressor(level=level).compress
        shard, made, held, parts, room = TaskContext.get().partitionId(), 0, [], [], block

        def row():
            ids = np.concatenate(held) if held else np.zeros(0, kind)
            planes = [shrink(p) for p in to_planes(ids, bits)] if len(ids) else []
            ends = np.cumsum([0, *map(len, planes)])
            index = [{"offset": int(o), "length": len(p)} for o, p in zip(ends, planes)]
            values = [shard, made, len(ids), kind.itemsize, index, b"".join(planes), parts]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _TYPES)], names=_NAMES)

        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(1)
            for i in range(len(ids)):
                text = texts[i].as_py()
                coded = encoder.encode_to_numpy(text, disallowed_special=()).astype(kind) if text else np.zeros(0, kind)
                at = 0
                while True:
                    take = min(room, len(coded) - at)
                    parts.append({"doc_id": ids[i], "start": block - room, "from": at, "length": take})
                    if take:
                        held.append(coded[at : at + take])
                    at, room = at + take, room - take
                    if not room:
                        yield row()
                        made, held, parts, room = made + 1, [], [], block
                    if at >= len(coded):
                        break
        if parts:
            yield row()

    source = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    return source.mapInArrow(write, SCHEMA)
