"""Byte-level BPE encoding and decoding over a hierarchical-bitmap rank queue.

One pre-token is merged in O(n log n): every adjacent pair whose concatenation has a
merge rank waits in that rank's bucket, a bucket holds positions of the linked list of
symbols, and a two-level bitmap over the ranks finds the lowest non-empty bucket with
two find-first-set steps. Entries are never deleted: one whose pair has changed since
it was queued is stale and skipped when it comes up. A bucket gives its positions from
left to right, so ties between equal ranks resolve as the library resolves them.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import file_bytes, kept, list_array, text_blocks

#: Bytes that a batch of decoded rows has at most; a longer row can't be a value of a binary column.
PIECE = (1 << 31) - 1
#: Distinct pre-tokens whose ids a worker remembers; it forgets all when the memory is full.
CACHE = 900_000


#: Fixed value: the pattern for which a text may be cut at single spaces.
SPACED = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A bitmap word spans 2**SPAN ranks; one root word has a bit for each of them.
SPAN = 8
BITS = [1 << i for i in range(1 << SPAN)]
MASK = (1 << SPAN) - 1


class ByteBPE:
    """Encoder and decoder for a rank table (``base64-token rank`` lines) and a pre-token pattern."""

    def __init__(self, table: bytes, pattern: str, cache: int = CACHE):
        import regex

        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, table.splitlines()) if a}
        self.tokens = {b: a for a, b in self.ranks.items()}
        top = max(self.tokens, default=0) + 1
        self.sizes = np.array([len(self.tokens.get(i, b"")) for i in range(top)], "i8")
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.blob = np.frombuffer(b"".join(self.tokens.get(i, b"") for i in range(top)), "u1")
        self.split = regex.compile(pattern).findall
        # In this pattern white space only ends a match, a run of it gives its last space to what
        # follows, and nothing looks back: a space with no white space beside it starts a match.
        self.cuts = pattern == SPACED
        self.unsafe = regex.compile(r"\s |  ?\s| \Z").search
        self.words = [0] * ((max(self.tokens, default=0) >> SPAN) + 1)  # all zero between pre-tokens
        self.seen: dict[str, bytes] = {}
        self.limit = cache

    def piece(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        get = self.ranks.get
        whole = get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        end = list(range(1, n + 2))  # of the symbol that starts here
        before = list(range(-1, n))  # start of the symbol to the left
        pair = [get(piece[i : i + 2]) for i in range(n - 1)]  # rank of the symbol here joined with the next one
        # the queue: root bitmap over words, words over ranks, buckets of positions (heaps)
        root, words, buckets, bits = 0, self.words, {}, BITS
        for i, rank in enumerate(pair):
            if rank is not None:
                if rank in buckets:
                    buckets[rank].append(i)  # ascending, so a heap already
                else:
                    buckets[rank] = [i]
                    w = rank >> SPAN
                    words[w] |= bits[rank & MASK]
                    root |= 1 << w
        pair += None, None
        while root:
            w = (root & -root).bit_length() - 1  # find first set, twice
            word = words[w]
            bit = word & -word
            rank = w << SPAN | bit.bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                word ^= bit
                words[w] = word
                if not word:
                    root ^= 1 << w
            if pair[i] != rank:
                continue  # stale
            gone = end[i]
            stop = end[i] = end[gone]
            pair[gone] = None
            if stop < n:
                before[stop] = i
                rank = pair[i] = get(piece[i : end[stop]])
                if rank is not None:
                    if rank in buckets:
                        heappush(buckets[rank], i)
                    else:
                        buckets[rank] = [i]
                        w = rank >> SPAN
                        words[w] |= bits[rank & MASK]
                        root |= 1 << w
            else:
                pair[i] = None
            left = before[i]
            if left >= 0:
                rank = get(piece[left:stop])
                if rank != pair[left]:
                    pair[left] = rank
                    if rank is not None:
                        if rank in buckets:
                            heappush(buckets[rank], left)
                        else:
                            buckets[rank] = [left]
                            w = rank >> SPAN
                            words[w] |= bits[rank & MASK]
                            root |= 1 << w
        out, i = [], 0
        while i < n:
            out.append(get(piece[i : end[i]]))
            i = end[i]
        return out

    def _part(self, part: str) -> bytes:
        seen, out = self.seen, []
        for token in self.split(part):
            got = seen.get(token)
            if got is None:
                got = array("I", self.piece(token.encode("utf-8", "surrogatepass"))).tobytes()
                self._remember(token, got)
            out.append(got)
        return b"".join(out)

    def _remember(self, part: str, ids: bytes) -> None:
        if len(part) <= 64:  # long ones hardly come again
            if len(self.seen) >= self.limit:
                self.seen.clear()
            self.seen[part] = ids

    def packed(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit integers.

        Where the pattern lets no match run over a space between two other characters, the
        text is cut there first and the ids of each part are remembered as a whole.
        """
        if not self.cuts or self.unsafe(text):
            return self._part(text)
        seen, out = self.seen, []
        first, *rest = text.split(" ")
        for part in [first, *[" " + x for x in rest]]:
            got = seen.get(part)
            if got is None:
                got = self._part(part)
                self._remember(part, got)
            out.append(got)
        return b"".join(out)

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text or ""), "<u4").tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def decode_flat(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of many ids, and where each id's bytes end in them."""
        sizes = self.sizes[ids]
        if not sizes.all():
            raise ValueError("an id has no token")
        ends = np.cumsum(sizes)
        out = np.arange(ends[-1] if len(ends) else 0, dtype="i8")
        out += np.repeat(self.begins[ids] - (ends - sizes), sizes)
        return self.blob[out], ends


def built(table: bytes, pattern: str) -> ByteBPE:
    """One for each worker process and table."""
    return kept("bpe", hash(table), len(table), pattern, build=lambda: ByteBPE(table, pattern))


def encode(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids array<int>``: the ids of every whole text, in a narrow pass without a shuffle.

    Every match of ``pattern`` is encoded separately; special tokens are not looked for.
    A null or empty text has no ids; a null id stays null; repeated rows are encoded each;
    other columns are ignored whatever their names; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(file_bytes(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = built(table.value, pattern)
        for batch in text_blocks(batches):
            parts = [codec.packed(x or "") for x in batch.column("text").to_pylist()]
            ids = np.frombuffer(b"".join(parts), "<u4").astype("i4")
            yield pa.RecordBatch.from_arrays([batch.column("id"), list_array(ids, [len(x) // 4 for x in parts], pa.int32())], ["id", "ids"])

    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``encoded``'s id and ids columns with ``decoded binary``, the bytes that the ids stand for.

    Null ids decode to empty bytes. An id outside the table is an error.
    """
    spark = encoded.sparkSession
    table = spark.sparkContext.broadcast(file_bytes(ranks_path))

    def pieces(codec: ByteBPE, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = part.column("ids")
        ids = lists.flatten().to_numpy()
        if codec.sizes[ids].sum() >= PIECE:  # offsets of a binary column have 32 bits
            if len(part) == 1:
                raise ValueError(f"one row stands for more than {PIECE} bytes")
            yield from pieces(codec, part.slice(0, len(part) // 2))
            yield from pieces(codec, part.slice(len(part) // 2))
            return
        data, ends = codec.decode_flat(ids)
        sizes = np.array([x or 0 for x in pc.list_value_length(lists).to_pylist()], "i8")
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])].astype("i4")
        decoded = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(edges), pa.py_buffer(data)])
        yield pa.RecordBatch.from_arrays([part.column("id"), lists, decoded], ["id", "ids", "decoded"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = built(table.value, pattern)
        for batch in batches:
            # a batch of short ids may stand for many bytes: slices keep what is held small
            for at in range(0, batch.num_rows, 500):
                yield from pieces(codec, batch.slice(at, 500))

    kind = encoded.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())])
    given = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return given.mapInArrow(run, schema).withColumnRenamed("id", id_col).withColumnRenamed("ids", ids_col)


def digests(decoded: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """The digest columns of the query contract, from ids and decoded bytes."""
    return decoded.select(
        F.col(id_col),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
