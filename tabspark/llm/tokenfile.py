"""Token-id files in directly addressable codes.

File format (one row of a Parquet file = one segment; Spark's committer makes the files
whole or absent, so a lost executor only costs a retry):

* ``shard, seq``: the shard (an ascending range of ids) and the segment's place in it;
* ``local_start``: ids of the shard before this segment; ``n_ids``: ids in the segment;
* ``doc_ids``, ``doc_lengths``: its documents in file order;
* ``levels``: number of chunk levels, then for each level a chunk array (``chunks_k``), a
  continuation bitmap (``more_k``) and a rank directory (``rank_k``), concatenated in
  ``body`` with their byte lengths in ``layout``.

An id is cut into ``CHUNK_BITS``-bit chunks, low ones first. Level k holds the k-th chunk of
every id that has one; its bitmap says which of them go on in level k+1. The place there is
the rank of the bit, read from the directory (set bits before each 512-bit block) plus a
popcount within the block, so any single id is read by one probe a level: ``Segment.get``.
"""

from __future__ import annotations

import gc
import os
import zlib
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_LIMIT, LOWER, file_bytes, kept, list_array, scratch, text_bytes

CHUNK_BITS = 8
#: Bits of a rank-directory block.
RANK_BLOCK = 512
#: Ids of a segment at most, but for one longer document.
SEGMENT_IDS = 1 << 20
#: Distinct words whose ids a worker remembers.
CACHE = 800_000
#: ASCII punctuation but for the apostrophe, with which contractions begin.
ENDING = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


# ---- the codes -------------------------------------------------------------------------


def pack(ids: np.ndarray) -> tuple[bytes, list[int]]:
    """``body, layout`` of the codes of unsigned ids."""
    rest, parts = ids.astype("u4"), []
    while len(rest):
        chunks = (rest & 0xFF).astype("u1")
        more = rest >= 1 << CHUNK_BITS
        bits = np.packbits(more, bitorder="little")
        pad = np.zeros(-(-len(bits) // (RANK_BLOCK // 8)) * (RANK_BLOCK // 8), "u1")
        pad[: len(bits)] = bits
        per = np.bitwise_count(pad.reshape(-1, RANK_BLOCK // 8)).sum(axis=1)
        rank = np.concatenate([[0], np.cumsum(per)[:-1]]).astype("<u4")
        parts += [chunks.tobytes(), pad.tobytes(), rank.tobytes()]
        rest = rest[more] >> CHUNK_BITS
    return b"".join(parts), [len(x) for x in parts]


class Segment:
    """Reader of one segment's codes."""

    def __init__(self, body: bytes, layout: list[int]):
        self.levels, at = [], 0
        for k in range(0, len(layout), 3):
            views = []
            for size, kind in zip(layout[k : k + 3], ("u1", "u1", "<u4"), strict=True):
                views.append(np.frombuffer(body, kind, size // np.dtype(kind).itemsize, at))
                at += size
            self.levels.append(tuple(views))

    def get(self, i: int) -> int:
        """The i-th id, by one probe of each level."""
        value, shift = 0, 0
        for chunks, more, rank in self.levels:
            value |= int(chunks[i]) << shift
            if not more[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BLOCK
            first, last = block * RANK_BLOCK // 8, i >> 3
            within = int(np.bitwise_count(more[first:last]).sum()) + (int(more[last]) & (1 << (i & 7)) - 1).bit_count()
            i, shift = int(rank[block]) + within, shift + CHUNK_BITS
        return value

    def all(self) -> np.ndarray:
        """All ids in order (u4)."""
        if not self.levels:
            return np.zeros(0, "u4")
        out = None
        for chunks, more, _ in reversed(self.levels):
            ids = chunks.astype("u4")
            if out is not None and len(out):
                on = np.unpackbits(more, count=len(chunks), bitorder="little").astype(bool)
                ids[on] |= out << CHUNK_BITS
            out = ids
        return out


# ---- encoding --------------------------------------------------------------------------


class Words:
    """Ids of whole texts, word by word.

    Valid for tokenizers that never let a token or a special token span ASCII white space
    (checked on load for the pre-tokenizers this knows): each word's ids come from the
    library and are remembered, so the library sees each frequent word once.
    """

    def __init__(self, table: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_str(table.decode())
        self.by_word = self._splits(table)
        self.seen: dict[bytes, bytes] = {}

    def _splits(self, table: bytes) -> bool:
        import json

        spec = json.loads(table)
        pre = spec.get("pre_tokenizer") or {}
        first = (pre.get("pretokenizers") or [pre])[0]
        self.ends = np.zeros(max(spec["model"]["vocab"].values()) + 1 + len(spec.get("added_tokens", [])), bool)
        suffix = spec["model"].get("end_of_word_suffix")
        lowers = any(n.get("type") == "Lowercase" for n in (spec.get("normalizer") or {}).get("normalizers", []))
        if not suffix or not lowers:
            return False
        self.ends[[i for t, i in spec["model"]["vocab"].items() if t.endswith(suffix)]] = True
        drops = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and "[^\\s" in first["pattern"].get("Regex", "")
        fixed = all(not (t.get("lstrip") or t.get("rstrip") or t.get("single_word")) and not any(c.isspace() for c in t["content"]) for t in spec.get("added_tokens", []))
        return bool(drops and fixed)

    def packed(self, raw: list[bytes]) -> list[bytes]:
        """The ids of each text (UTF-8) as little-endian 32-bit integers."""
        if not self.by_word:
            return [np.array(e.ids, "<u4").tobytes() for e in self.lib.encode_batch_fast([x.decode() for x in raw], add_special_tokens=False)]
        seen = self.seen
        if len(seen) > CACHE:
            seen.clear()
        # the normalizer lower-cases: so may this, but for what could be a special token
        words = [(x if b"<|" in x else x.translate(LOWER)).split() for x in raw]
        flat = list(chain.from_iterable(words))
        got = list(map(seen.get, flat))
        gaps = [i for i, ids in enumerate(got) if ids is None]
        new = list({flat[i] for i in gaps})
        # an ASCII punctuation run after a letter is a pre-token of its own
        cores = [w.rstrip(ENDING) for w in new]
        cut = [(w, c, w[len(c) :]) for w, c in zip(new, cores, strict=True) if len(c) < len(w) and (c[-1:].islower() or c[-4:].decode("utf-8", "ignore")[-1:].isalpha()) and b"<|" not in w]
        parts = set(new).difference(w for w, _, _ in cut)
        parts.update(p for _, c, tail in cut for p in (c, tail) if p not in seen)
        self._learn(list(parts))
        for w, c, tail in cut:
            seen[w] = seen[c] + seen[tail]
        for i in gaps:
            got[i] = seen[flat[i]]
        ends = list(accumulate(map(len, words)))
        return [b"".join(got[s:e]) for s, e in zip([0, *ends], ends, strict=False)]

    def _learn(self, parts: list[bytes]) -> None:
        """The library's ids of each part.

        Words of letters alone are one pre-token, whose last token (and no other) ends a
        word: they go to the library in lines of many, if the number of ends confirms it.
        """
        seen, rest = self.seen, []
        lines: list[tuple[bytes, str]] = []
        for p in parts:
            x = p.decode()
            (lines if x.isalpha() else rest).append((p, x))
        for at in range(0, len(lines), 20_000):
            part = lines[at : at + 20_000]
            ids = np.array(self.lib.encode_batch_fast(["\n".join(x for _, x in part)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(part):
                rest += part
                continue
            data, stops = ids.tobytes(), (ends * 4).tolist()
            for (p, _), s, e in zip(part, [0, *stops], stops, strict=False):
                seen[p] = data[s:e]
        for at in range(0, len(rest), 10_000):
            part = rest[at : at + 10_000]
            for (p, _), e in zip(part, self.lib.encode_batch_fast([x for _, x in part], add_special_tokens=False), strict=True):
                seen[p] = np.array(e.ids, "<u4").tobytes()


def built(table: bytes) -> Words:
    """One for each worker process and table."""
    return kept("tokenfile", hash(table), len(table), build=lambda: Words(table))


#: Bytes of input files for a shard, about.
SHARD = 128 << 20
SEGMENTS = T.StructType(
    [
        T.StructField("shard", T.IntegerType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("local_start", T.LongType()),
        T.StructField("n_ids", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("doc_lengths", T.ArrayType(T.LongType())),
        T.StructField("layout", T.ArrayType(T.LongType())),
        T.StructField("body", T.BinaryType()),
    ]
)


def write(docs: DataFrame, tokenizer_path: str, path: str | None = None, *, end_id: int = 1, shards: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encode every whole text and write the token files; returns their path.

    The texts are dealt by ascending ``id_col`` ranges (one exchange of the texts, no
    second tokenization for the sampling) and sorted in each range by id, then text, so
    repeated ids have a fixed order; a null id comes first. ``end_id`` ends each document;
    a null text is empty and has that id alone. Special strings are handled as is the
    library's default. Other columns are ignored; an empty table gives no segments.
    """
    spark = docs.sparkSession
    path = path or scratch(spark, "token-files")
    table = spark.sparkContext.broadcast(file_bytes(tokenizer_path))
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, shard = built(table.value), TaskContext.get().partitionId()
        gc.disable()  # nothing here makes cycles, and each collection would walk all that is remembered
        doc_ids, parts, held, seq, start = [], [], 0, 0, 0

        def segment() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            body, layout = pack(ids)
            lengths = np.array([len(x) // 4 for x in parts], "i8")
            row = [[shard], [seq], [start], [len(ids)], [doc_ids], [lengths], [layout], [body]]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()), strict=True)], SEGMENTS.names)

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                for i, x in zip(part.column("id").to_pylist(), words.packed(text_bytes(part)), strict=True):
                    if held and held + len(x) // 4 + 1 > SEGMENT_IDS:
                        yield segment()
                        start, seq, held, doc_ids, parts = start + held, seq + 1, 0, [], []
                    doc_ids.append(i)
                    parts.append(x + tail)
                    held += len(x) // 4 + 1
        if parts:
            yield segment()

    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # as many shards as the session sets for exchanges, more where the input is larger than that allows for
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if shards is None and size // SHARD > int(spark.conf.get("spark.sql.shuffle.partitions")):
        shards = size // SHARD
    dealt = given.repartitionByRange(shards, "id") if shards else given.repartitionByRange("id")
    dealt.sortWithinPartitions("id", "text").mapInArrow(run, SEGMENTS).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """``shard, seq, start, n_ids, doc_ids, doc_lengths, layout, body``: the segments with global starts.

    Shard totals (a row for each shard: as many as the writing job had tasks) are summed
    up in shard order and joined back; the bodies are not shuffled.
    """
    segments = spark.read.schema(SEGMENTS).parquet(path)
    totals = segments.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    if spark.read.schema(SEGMENTS).parquet(path).select("shard").distinct().count() * 16 > BROADCAST_LIMIT:
        wide = lambda x: x
    else:
        wide = F.broadcast
    before = totals.select("shard", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("before"))
    return segments.join(wide(before), "shard").withColumn("start", F.col("before") + F.col("local_start")).drop("before", "local_start")


def documents(spark: SparkSession, path: str, *, id_col: str = "doc_id") -> DataFrame:
    """``id_col, start, n_tokens, ids_crc32`` of every document, decoded from the files."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                ids = Segment(one.column("body")[0].as_py(), one.column("layout")[0].as_py()).all().astype("<u4")
                lengths = one.column("doc_lengths")[0].values.to_numpy()
                ends = np.cumsum(lengths)
                view = memoryview(ids.tobytes())
                crc = [zlib.crc32(view[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                starts = one.column("start")[0].as_py() + ends - lengths
                yield pa.RecordBatch.from_arrays([one.column("doc_ids")[0].values, pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())], schema.names)

    given = read(spark, path).select("start", "doc_ids", "doc_lengths", "layout", "body")
    return given.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def tokens(spark: SparkSession, path: str, *, id_col: str = "doc_id") -> DataFrame:
    """``id_col, ids array<int>``: the documents' ids, decoded from the files."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                ids = Segment(one.column("body")[0].as_py(), one.column("layout")[0].as_py()).all().astype("i4")
                yield pa.RecordBatch.from_arrays([one.column("doc_ids")[0].values, list_array(ids, one.column("doc_lengths")[0].values.to_numpy(), pa.int32())], schema.names)

    return read(spark, path).select("doc_ids", "doc_lengths", "layout", "body").mapInArrow(run, schema).withColumnRenamed("id", id_col)


def get_token(spark: SparkSession, path: str, position: int) -> int | None:
    """The id at a global position, by one segment's row and one probe a level; None outside."""
    found = read(spark, path).where((F.col("start") <= position) & (F.col("start") + F.col("n_ids") > position)).select("start", "layout", "body").head()
    return None if found is None else Segment(bytes(found.body), found.layout).get(position - found.start)
