"""Token-ID / binary output, and concatenate-and-cut packing over the same files.

Both tokenise every whole text once, write shards (see ``eliasfano``) to the
shared folder, and turn the shards' token totals into global offsets by a prefix
sum over the manifest (one short row a shard).

Order: ascending ``doc_id`` (nulls first), ties by a hash of the text, then the
text. Range partitioning gives that order whatever the number of partitions, so
reruns on other clusters give the same files' contents and offsets.

Defined cases: a null text is the empty text (its document is the end id alone);
a null ``doc_id`` is kept and comes first; repeated rows are documents of their
own; an empty table gives no shards and no rows; other columns are ignored, also
those named like the output.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .eliasfano import Shard, shard_encode
from .store import materialize, read_file, shared_dir, write_file
from .tokens import tokenizer

MANIFEST = "part int, seq int, path string, n_docs long, n_ids long"
#: ids in one shard, before which a shard is closed. Raise it with the data: the manifest has a row a shard.
SHARD_IDS = 4_000_000


def write_token_shards(docs: DataFrame, tokenizer_path: str, end_id: int, drops_space: bool, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Tokenise ``docs`` (doc_id, text) into shards; returns the manifest with
    ``base``, the ids of all shards before. A task holds one shard at a time."""
    out = shared_dir(docs.sparkSession, "tokens")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, tok = TaskContext.get().partitionId(), tokenizer(tokenizer_path, drops_space)
        end = np.array([end_id], tok.dtype).tobytes()
        keys, lengths, ids, held, seq = [], [], [], 0, 0

        def close():
            nonlocal keys, lengths, ids, held, seq
            path = f"{out}/{part:06d}-{seq:06d}-{uuid.uuid4().hex}.slef"
            write_file(path, [shard_encode(keys, lengths, b"".join(ids), tok.dtype.itemsize)])
            row = [[part], [seq], [path], [len(keys)], [held]]
            keys, lengths, ids, held, seq = [], [], [], 0, seq + 1
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))], ["part", "seq", "path", "n_docs", "n_ids"])

        for batch in batches:
            for k in range(0, len(batch), 500):
                some = batch.slice(k, 500)
                for key, raw in zip(some["doc_id"].to_pylist(), tok.encode_batch(some["text"].to_pylist())):
                    keys.append(key)
                    ids.append(raw + end)
                    lengths.append(len(ids[-1]) // tok.dtype.itemsize)
                    held += lengths[-1]
                    if held >= shard_ids:
                        yield close()
        if keys:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text"), "text"]
    rows = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    manifest = materialize(rows.mapInArrow(write, MANIFEST), "manifest")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _spread(manifest: DataFrame) -> DataFrame:
    """A task a few shards; the manifest itself is tiny."""
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(manifest, "offsets").repartition(n, "part", "seq")


def read_token_shards(manifest: DataFrame) -> DataFrame:
    """Documents of the shards: doc_id, start, n_tokens, ids_crc32, ids."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch["path"].to_pylist(), batch["base"].to_pylist()):
                shard = Shard(read_file(path))
                keys = shard.keys()
                for lo in range(0, shard.n_docs, 4096):
                    hi = min(lo + 4096, shard.n_docs)
                    ends = shard.ends.slice(lo, hi)
                    starts = np.concatenate([[shard.ends[lo - 1] if lo else 0], ends[:-1]])
                    crc = [zlib.crc32(shard.ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                    yield pa.RecordBatch.from_arrays([pa.array(keys[lo:hi], pa.int64()), pa.array(starts + base), pa.array(ends - starts), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _spread(manifest).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def pack_concat(manifest: DataFrame, window: int = 2048) -> DataFrame:
    """Concatenate all documents and cut the stream every ``window`` ids.

    A row is a piece: doc_id, start (ids of its document before it), length,
    ids_crc32, doc_tokens, sequence_id, offset (in the sequence), and
    padded_length, the length its sequence is stored in: ``window``, or the fill
    of the last sequence where that is a power of two. A document that crosses
    a cut has a boundary record on either side. Padding is below one window in all.
    """
    total = F.coalesce(F.sum("n_ids").over(Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.lit(0))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base, total in zip(*(batch[c].to_pylist() for c in ("path", "base", "total"))):
                shard = Shard(read_file(path))
                keys = shard.keys()
                fill = total % window or window
                for lo in range(0, shard.n_docs, 4096):
                    hi = min(lo + 4096, shard.n_docs)
                    ends = shard.ends.slice(lo, hi)
                    starts = np.concatenate([[shard.ends[lo - 1] if lo else 0], ends[:-1]])
                    a, z = starts + base, ends + base
                    n = (z - 1) // window - a // window + 1
                    doc = np.repeat(np.arange(hi - lo), n)
                    nth = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                    seq = (a // window)[doc] + nth
                    left = np.maximum(a[doc], seq * window)
                    right = np.minimum(z[doc], (seq + 1) * window)
                    crc = [zlib.crc32(shard.ids[x:y].astype("<u4").tobytes()) for x, y in zip((left - base).tolist(), (right - base).tolist())]
                    stored = np.where((seq + 1) * window <= total, window, fill if fill & (fill - 1) == 0 else window)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[lo:hi], pa.int64()).take(pa.array(doc)), pa.array(left - a[doc]), pa.array(right - left), pa.array(crc, pa.int64()), pa.array((ends - starts)[doc]), pa.array(seq), pa.array(left - seq * window), pa.array(stored.astype(np.int64))],
                        ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_length"],
                    )

    return _spread(manifest.withColumn("total", total)).mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded_length long")
