"""Benchmark decontamination by a prefix-filtered set join.

The shingles of an item window are its word pairs. A document that contains the window
contains all of them, so one is a sufficient prefix: the rarest, by counts over all
documents in a sketch of fixed size. The join, all of it distributed:

1. items are cut into windows, equal windows being one. Documents are read once to count the
   shingles of windows; so each window has its prefix shingle and the shingle's place in it;
2. documents give a row for each place of a prefix shingle, with the words around it. A bit
   table of the prefix shingles, of bounded size, lets most other places go at once (as another
   one does in the counts);
3. places and windows meet by an equi-join on the shingle. The window must fit into the text
   at that place (length and positional bounds), and its words are compared one by one;
4. the windows found are merged into hit words and items by the content of a text, and join
   back to its rows by that key: texts themselves never move.

A shingle that the sketch counts more than ``HOT`` times is dealt to several tasks, with its
windows in each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_LIMIT, WordHash, kept, materialize, mix, near, release, sum_sketch, text_blocks, text_bytes

#: Words of a window.
WINDOW = 10
#: Counters of the sketch; places of a shingle from which on it is dealt to several tasks.
SKETCH, HOT = 1 << 22, 200_000
#: Bits of a bit table: at least, for each shingle, and at most. A fuller table lets more places
#: through to the join, which then finds nothing there.
BITS, BITS_EACH, BITS_MOST = 1 << 24, 1 << 10, 8 * BROADCAST_LIMIT // 2
#: A-Z to lower case; what ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` leaves out becomes a space.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
#: Marks the shingle of a window of one word.
ALONE = 0xC2B2AE3D27D4EB4F


def words(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def pairs_of(h: np.ndarray) -> np.ndarray:
    """The shingle that starts at each word but the last."""
    return mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])


def singles_of(h: np.ndarray) -> np.ndarray:
    return mix(h ^ np.uint64(ALONE))


def _cell(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(22)).astype("i8") & SKETCH - 1


def _parts(counts: np.ndarray, hot: int) -> np.ndarray:
    """Over how many tasks a shingle of so many places is dealt."""
    return 1 + counts.astype("i8") // hot


def content(text: Column) -> Column:
    """The key of a text, null as the empty one."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


def _may(table: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """The places of the shingles that a bit table lets through."""
    low = (shingles & np.uint64(len(table) * 8 - 1)).astype("i8")
    return np.flatnonzero(table[low >> 3] >> (low & 7).astype("u1") & 1)


def _sketch(texts: DataFrame, table: Broadcast) -> np.ndarray:
    """Occurrences in all documents of the word pairs that the table lets through, by cells of a sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        kept("decontam")
        known, total = WordHash(), np.zeros(SKETCH, "u4")
        for batch in text_blocks(batches):
            # a pair over the end of a text counts too: only the order depends on these counts
            h = known.of([w for x in text_bytes(batch) for w in words(x)])
            if len(h) > 1:
                pairs = pairs_of(h)
                np.add.at(total, _cell(pairs[_may(table.value, pairs)]), 1)
        yield total

    return np.minimum(sum_sketch(texts, run, SKETCH), np.uint64(2**32 - 1)).astype("u4")


def _windows(benchmark: DataFrame, window: int, item_col: str, text_col: str) -> DataFrame:
    """``item, words, n``: the distinct windows of each item, words with a space between."""
    rows = benchmark.select(F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("null")).alias("item"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, 1 << 20):
            for item, text in zip(batch.column("item").to_pylist(), text_bytes(batch), strict=True):
                w = words(text)
                n = min(window, len(w))
                found = sorted({b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)}) if n else []
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(found)), pa.array([x.decode() for x in found]), pa.array([n] * len(found), pa.int32())], ["item", "words", "n"])

    return rows.mapInArrow(run, "item string, words string, n int").distinct()


def _shingles(windows: DataFrame) -> DataFrame:
    """``shingle`` of all the windows' word pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("decontam")
        known = WordHash()
        for batch in batches:
            found = [pairs_of(known.of(x.encode().split())) for x in batch.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)).view("i8") if found else [], pa.int64())], ["shingle"])

    return windows.where("n > 1").select("words").mapInArrow(run, "shingle long")


def _prefixes(windows: DataFrame, sketch: Broadcast, hot: int) -> DataFrame:
    """``shingle, salt, offset, n, words`` of each distinct window: its rarest shingle, for each task that it is dealt to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("decontam")
        known, counts = WordHash(), sketch.value
        for batch in batches:
            out = []
            for text, n in zip(batch.column("words").to_pylist(), batch.column("n").to_pylist(), strict=True):
                h = known.of(text.encode().split())
                if n > 1:
                    shingles = pairs_of(h)
                    seen = counts[_cell(shingles)]
                    at = int(np.argmin(seen))
                    parts = int(_parts(seen[at : at + 1], hot)[0])
                else:
                    shingles, at, parts = singles_of(h), 0, 1
                out += [(int(shingles[at : at + 1].view("i8")[0]), salt, at, n, text) for salt in range(parts)]
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string()), strict=True)], ["shingle", "salt", "offset", "n", "words"])

    return windows.select("words", "n").distinct().mapInArrow(run, "shingle long, salt int, offset int, n int, words string")


def _bit_table(shingles: DataFrame) -> np.ndarray:
    """A bit for each shingle, by its last bits; of a bounded size, however many there are."""
    shingles = shingles.distinct()
    bits, wanted = BITS, BITS_EACH * shingles.count()
    while bits < min(BITS_MOST, wanted):
        bits *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        table = np.zeros(bits // 8, "u1")
        for batch in batches:
            low = (batch.column("shingle").to_numpy().view("u8") & np.uint64(bits - 1)).astype("i8")
            np.bitwise_or.at(table, low >> 3, np.uint8(1) << (low & 7).astype("u1"))
        yield table

    return sum_sketch(shingles, run, bits // 8, either=True)


def _places(docs: DataFrame, id_type: T.DataType, sketch: Broadcast, table: Broadcast, window: int, hot: int, singles: bool) -> DataFrame:
    """A row for each document, ``id, content, n_words`` (shingle null), and for each place that may have a
    prefix shingle ``content, n_words, shingle, salt, place, first, around``: the words around it, from
    word ``first`` on."""

    names = ["id", "content", "n_words", "shingle", "salt", "place", "first", "around"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("decontam")
        known, counts, bits = WordHash(), sketch.value, table.value

        for batch in text_blocks(batches):
            split = [words(x) for x in text_bytes(batch)]
            ends = np.cumsum([len(x) for x in split])
            starts = ends - np.array([len(x) for x in split], "i8")
            flat = [w for x in split for w in x]
            none = pa.nulls(batch.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("content"), pa.array(ends - starts, pa.int64()), pa.nulls(batch.num_rows, pa.int64()), none, none, none, pa.nulls(batch.num_rows, pa.list_(pa.binary()))], names)
            h = known.of(flat)
            found = []
            if len(h) > 1:
                pairs = pairs_of(h)
                at = _may(bits, pairs)
                text = np.searchsorted(ends, at, "right")
                inside = at + 1 < ends[text]  # not over the end of a text
                at, text = at[inside], text[inside]
                found.append((at, text, pairs[at], np.arange(len(at)) % _parts(counts[_cell(pairs[at])], hot)))
            if singles and len(h):
                alone = singles_of(h)
                at = _may(bits, alone)
                found.append((at, np.searchsorted(ends, at, "right"), alone[at], np.zeros(len(at), "i8")))
            for at, text, shingle, salt in found:
                low, high = np.maximum(starts[text], at - (window - 2) if window > 1 else at), np.minimum(ends[text], at + window)
                for s in range(0, len(at), 20_000):
                    e = min(s + 20_000, len(at))
                    around = pa.array([flat[a:b] for a, b in zip(low[s:e].tolist(), high[s:e].tolist(), strict=True)], pa.list_(pa.binary()))
                    t = text[s:e]
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(e - s, batch.column("id").type), batch.column("content").take(pa.array(t)), pa.array((ends - starts)[t], pa.int64()), pa.array(shingle[s:e].view("i8"), pa.int64()), pa.array(salt[s:e], pa.int32()), pa.array(at[s:e] - starts[t], pa.int32()), pa.array(low[s:e] - starts[t], pa.int32()), around], names
                    )

    kinds = [id_type, T.BinaryType(), T.LongType(), T.LongType(), T.IntegerType(), T.IntegerType(), T.IntegerType(), T.ArrayType(T.BinaryType())]
    return docs.mapInArrow(run, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]))


def occurrences(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, id_col: str | None = None, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """``(id, content, n_words)`` of every row of ``docs`` (id null without ``id_col``), and
    ``content, n_hit, spans, items`` of every text in which an item window occurs.

    ``spans``: array of (first, end) words of each maximal run of hit words. ``items``: ids, as
    strings in ascending order, of the items of which a window occurs; an item of fewer words
    than a window is one window, one without words has none, and a null item id is listed as
    ``null``. A null text has no words. Equal texts are one. Empty documents or an empty
    benchmark give what follows from that; other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    text = F.col(f"`{text_col}`").cast("string")
    given = docs.select((F.col(f"`{id_col}`") if id_col else F.lit(None).cast("long")).alias("id"), content(text).alias("content"), text.alias("text"))
    windows = materialize(_windows(benchmark, window, item_col, item_text), "decontam-windows")
    every = spark.sparkContext.broadcast(_bit_table(_shingles(windows)))
    sketch = spark.sparkContext.broadcast(_sketch(given.select("text"), every))
    prefixes = materialize(_prefixes(windows, sketch, hot), "decontam-prefixes")
    table = spark.sparkContext.broadcast(_bit_table(prefixes.select("shingle")))
    singles = not prefixes.where("n = 1").isEmpty()
    rows = materialize(_places(given, given.schema["id"].dataType, sketch, table, window, hot, singles), "decontam-places")
    places = rows.where("shingle IS NOT NULL").drop("id")
    start = F.col("place") - F.col("offset")
    fits = (start >= F.col("first")) & (start + F.col("n") <= F.col("n_words"))
    same = F.array_join(F.transform(F.slice("around", start - F.col("first") + 1, F.col("n")), lambda w: w.cast("string")), " ") == F.col("words")
    met = places.join(near(prefixes), ["shingle", "salt"]).where(fits).where(same)
    found = materialize(met.select("content", start.alias("start"), (start + F.col("n")).alias("stop"), "words").distinct(), "decontam-found")
    release(prefixes)
    # merge the windows of a text, in order, into runs of hit words
    walked = F.aggregate(
        F.sort_array(F.collect_set(F.struct("start", "stop"))),
        F.array().cast("array<struct<start:int,stop:int>>"),
        lambda runs, s: F.when((F.size(runs) > 0) & (s["start"] <= F.element_at(runs, -1)["stop"]), F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(F.struct(F.element_at(runs, -1)["start"].alias("start"), F.greatest(F.element_at(runs, -1)["stop"], s["stop"]).alias("stop"))))).otherwise(
            F.concat(runs, F.array(F.struct(s["start"].alias("start"), s["stop"].alias("stop"))))
        ),
    )
    spans = found.groupBy("content").agg(walked.alias("spans"))
    spans = spans.withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"]))
    items = found.select("content", "words").distinct().join(windows, "words").select("content", "item").distinct().groupBy("content").agg(F.sort_array(F.collect_list("item")).alias("items"))
    hits = materialize(spans.join(items, "content").select("content", "n_hit", "spans", "items"), "decontam-hits")
    release(found, windows)
    return rows.where("shingle IS NULL").select("id", "content", "n_words"), hits


def report(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """The query contract's columns, from :func:`occurrences`; a row for each row of ``docs``."""
    rows, hits = occurrences(docs, benchmark, window=window, id_col=id_col, text_col=text_col, hot=hot)
    n_hit, items = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(hits, "content", "left").select(F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item window occurs, with their own columns; null texts stay."""
    _, hits = occurrences(docs, benchmark, window=window, text_col=text_col)
    given = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("_row"), content(F.col(f"`{text_col}`")).alias("content"))
    return given.join(near(hits, "content"), "content", "left_anti").select("_row.*")
