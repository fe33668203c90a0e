"""Token ids in training order, as binary shards of fixed stride.

Documents are tokenised once into sequences of ``length`` ids (documents in a row, each closed; a partition's last sequence
is filled up with the closing id) and staged. Sequences are numbered across partitions by the counts before them, a keyed
Feistel permutation with cycle-walking sends each number to a slot in [0, sequences), and slots are range-partitioned and
written in order: shard k holds the slots from k x ``per_shard``, each ``2 x length`` bytes of little-endian uint16, so the
place of any slot is arithmetic and a reader resumes at any of them. A shard is written under a name of its attempt and then
moved to its own, so a lost executor's attempt leaves no half shard behind.

Defined results: a null text counts as empty and gives its closing id; null and repeated ids pass through; extra columns are
ignored; an empty table gives no shard and an empty result; a text may span any number of sequences. A vocabulary with ids
beyond 65,535 does not fit the shards and is refused before anything is written.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import starts_of
from .common import Scratch, new_path, text_of, written
from .packing import SLICE_BYTES
from .tokens import END, tokenizer

LENGTH, PER_SHARD, KEY, ROUNDS = 2048, 8192, 20240229, 6
MOST_TASKS = 1 << 16  # beyond as many shards a task writes several in a row
U, CODEC = np.uint64, ("zstd", 3)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def feistel(index: np.ndarray, n: int, key: int = KEY, rounds: int = ROUNDS) -> np.ndarray:
    """The places of ``index`` under a keyed permutation of [0, n): a balanced Feistel network over the least even number of
    bits that holds n, walked until the result is below n."""
    half = U(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = (U(1) << half) - U(1)
    out, todo = index.astype(U), np.arange(len(index))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for r in range(rounds):
            left, right = right, left ^ (_mix(right + U(key) + _mix(np.full(1, r + 1, U))) & mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= U(n)]
    return out.astype(np.int64)


def sequences(df: DataFrame, tokenizer_path: str, id_col: str, text_col: str, length: int) -> DataFrame:
    """(part, place, n_tokens, docs, ids): rows of ``length`` ids as compressed uint16 bytes, and the documents that each has
    ids of. They stay compressed until they are in their shard, on disk and in the exchange."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, place, codec = tokenizer(tokenizer_path), TaskContext.get().partitionId(), 0, pa.Codec(*CODEC)
        ids, names, ends, id_type = np.empty(0, np.uint32), [], np.empty(0, np.int64), None

        def out(count: int, real: int) -> pa.RecordBatch:
            starts = np.r_[0, ends[:-1]]
            rows = np.arange(count)
            first = np.searchsorted(ends, rows * length, "right")
            last = np.searchsorted(starts, np.minimum((rows + 1) * length, real), "left")
            raw = ids[: count * length].astype("<u2").tobytes()
            size = 2 * length
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(count, part), pa.int32()),
                    pa.array(place + rows),
                    pa.array(np.minimum(length, real - rows * length)),
                    pa.array([names[a:b] for a, b in zip(first, last)], pa.list_(id_type)),
                    pa.array([codec.compress(raw[k * size : (k + 1) * size], asbytes=True) for k in rows], pa.binary()),
                ],
                ["part", "place", "n_tokens", "docs", "ids"],
            )

        for piece, more, sizes in own.encode_slices(batches, 1, SLICE_BYTES):
            id_type = piece.column(0).type
            ends = np.r_[ends, len(ids) + np.cumsum(sizes)]
            ids, names = np.concatenate([ids, more]), names + piece.column(0).to_pylist()
            if count := len(ids) // length:
                yield out(count, count * length)
                place, used = place + count, count * length
                gone = int(np.searchsorted(ends, used, "right"))
                ids, names, ends = ids[used:], names[gone:], ends[gone:] - used
        if real := len(ids):
            ids = np.r_[ids, np.full(length - real, END, np.uint32)]
            yield out(1, real)

    rows = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, f"part int, place long, n_tokens long, docs array<{kind}>, ids binary")


def _place(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def write_token_shards(df: DataFrame, tokenizer_path: str, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, per_shard: int = PER_SHARD, key: int = KEY) -> DataFrame:
    """Writes the shards below ``path`` and returns the manifest, itself a written table: (slot, shard, row, sequence,
    n_tokens, docs, crc32), crc32 being that of the slot's bytes."""
    spark = df.sparkSession
    path, scratch = path or new_path(spark, "token-shards"), Scratch()
    if len(tokenizer(tokenizer_path).ends) > 1 << 16:
        raise ValueError("the vocabulary has ids that 16 bits do not hold")
    staged = scratch.written(sequences(df, tokenizer_path, id_col, text_col, length), "sequences")
    counts = staged.groupBy("part").agg(F.count("*").alias("n"))
    starts = scratch.written(counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("first"), "n"), "sequence-starts")
    total = starts.agg(F.sum("n")).first()[0] or 0

    def slot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = feistel(b.column("sequence").to_numpy(zero_copy_only=False), total, key)
            yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(s // per_shard), *b.columns], ["slot", "shard", *b.schema.names])

    numbered = staged.join(starts, "part").select((F.col("first") + F.col("place")).alias("sequence"), "n_tokens", "docs", "ids")
    slots = numbered.mapInArrow(slot, "slot long, shard long, sequence long, n_tokens long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema.fields[2:]))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by slot; a shard's rows are all in this partition."""
        fs, folder = _place(path)
        fs.create_dir(folder, recursive=True)
        open_shard, sink, tried, codec = None, None, "", pa.Codec(*CODEC)

        def close() -> None:
            if sink is not None:
                sink.close()
                fs.move(tried, f"{folder}/{shard_name(open_shard)}")

        for b in batches:
            shard = b.column("shard").to_numpy(zero_copy_only=False)
            edge, crc = np.flatnonzero(np.diff(shard)) + 1, []
            for a, z in zip(np.r_[0, edge], np.r_[edge, len(shard)]):
                if len(shard) and shard[a] != open_shard:
                    close()
                    open_shard, tried = int(shard[a]), f"{folder}/.{uuid.uuid4().hex}"
                    sink = fs.open_output_stream(tried)
                for x in b.column("ids")[a:z]:
                    raw = codec.decompress(x.as_buffer(), 2 * length)
                    crc.append(zlib.crc32(raw))
                    sink.write(raw)
            row = pa.array(b.column("slot").to_numpy(zero_copy_only=False) % per_shard)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in ("slot", "shard")), row, *(b.column(k) for k in ("sequence", "n_tokens", "docs")), pa.array(crc, pa.int64())], ["slot", "shard", "row", "sequence", "n_tokens", "docs", "crc32"])
        close()

    n = max(1, -(-total // per_shard))
    each = -(-n // MOST_TASKS)
    # The shard's number is the partition's: nothing is sampled to find ranges.
    ordered = slots.repartitionById(-(-n // each), F.floor(F.col("shard") / each).cast("int")).sortWithinPartitions("slot")
    kind = staged.schema["docs"].dataType.simpleString()
    out = written(ordered.mapInArrow(write, f"slot long, shard long, row long, sequence long, n_tokens long, docs {kind}, crc32 long"), "token-manifest")
    scratch.keep()
    return out


def read_slots(path: str, first: int, count: int, length: int = LENGTH, per_shard: int = PER_SHARD) -> np.ndarray:
    """Slots first, first + 1, ... in training order: sequential reads from the place that the numbers give."""
    fs, folder = _place(path)
    out, size = [], 2 * length
    while count > 0:
        shard, row = divmod(first, per_shard)
        with fs.open_input_file(f"{folder}/{shard_name(shard)}") as f:
            f.seek(row * size)
            raw = f.read(min(count, per_shard - row) * size)
        got = np.frombuffer(raw, "<u2").reshape(-1, length)
        if not len(got):
            break
        out.append(got)
        first, count = first + len(got), count - len(got)
    return np.concatenate(out) if out else np.empty((0, length), "<u2")
