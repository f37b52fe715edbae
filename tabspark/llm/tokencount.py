"""Token counts by overlap resynchronisation.

A long document is never encoded in one piece. It is read in chunks that overlap; each
chunk is encoded with offsets by the library. The chunk so far has *true* boundaries (an
encoding's pre-token starts that lie a margin before the chunk's end: what follows the
cut cannot have changed them). The next chunk starts inside the overlap, perhaps in the
middle of a word; once one of its own pre-token starts coincides with a true boundary,
everything that it yields from there equals the whole text's encoding, because pre-token
scanning looks only forward. Counts are spliced at such a boundary. Where the overlap has
none (one long run without a boundary), the overlap is widened, to the whole text at last.

Short documents are one chunk. Where the tokenizer's pre-token pattern lets no match run over
a single space between two other characters, such a text is cut there and a worker remembers
the library's count of each part; in all other cases the library counts the whole text.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import file_bytes, kept, text_blocks

#: Characters of a chunk and of the overlap that the next chunk is given at first.
CHUNK, OVERLAP = 1 << 15, 256
#: Distinct parts whose counts a worker remembers (those of up to ``LONGEST`` characters); it
#: forgets all when the memory is full.
KNOWN, LONGEST = 700_000, 64
#: A space that could belong to a run of white space, by any engine's notion of white space.
UNSAFE = re.compile("[\\s\x1c-\x1f\x85\u180e\u200b\ufeff] |  | [\\s\x1c-\x1f\x85\u180e\u200b\ufeff]| \\Z").search
#: Characters before a cut whose scanning could depend on what follows it: longer than any
#: look-ahead or fixed alternative of the pattern and than any special token (checked on load).
MARGIN = 32


class Counter:
    def __init__(self, table: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_str(table.decode())
        self.cuts = self._cuts(json.loads(table))
        self.known: dict[str, int] = {}  # tokens of a part, the space before it included but not written
        longest = max((len(t.content) for t in self.lib.get_added_tokens_decoder().values()), default=0)
        if longest > MARGIN - 8:
            raise ValueError(f"a special token of {longest} characters needs a larger margin")

    def whole(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def _cuts(spec: dict) -> bool:
        """Whether a single space between two other characters always starts a pre-token.

        So it is for the byte-level pre-tokenizer's own pattern (a match takes white space in
        front only, nothing looks back), if nothing else is done to the text before and no
        added token holds white space or takes that around it.
        """
        pre = spec.get("pre_tokenizer") or {}
        plain = all(not (t.get("lstrip") or t.get("rstrip") or t.get("single_word") or UNSAFE(f"{t['content']} x") or re.search(r"\s", t["content"])) for t in spec.get("added_tokens") or [])
        return bool(plain and not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec["model"].get("dropout"))

    def short(self, texts: list[str]) -> list[int]:
        """Tokens of texts of bounded length."""
        if not self.cuts:
            return self.whole(texts)
        known = self.known
        parts = [None if UNSAFE(x) else x.split(" ") for x in texts]
        # the first part has no space before it: it goes to the library each time, as do uncut texts
        alone = self.whole([x if p is None else p[0] for x, p in zip(texts, parts, strict=True)])
        rest = [p[1:] if p else [] for p in parts]
        if len(known) > KNOWN:
            known.clear()
        new = list(set(chain.from_iterable(rest)).difference(known))
        counts = dict(zip(new, self.whole([" " + x for x in new]), strict=True))
        known.update((x, n) for x, n in counts.items() if len(x) <= LONGEST)
        long = {x: n for x, n in counts.items() if len(x) > LONGEST}
        if long:
            return [n + sum([long[x] if x in long else known[x] for x in p]) for n, p in zip(alone, rest, strict=True)]
        return [n + sum(map(known.__getitem__, p)) for n, p in zip(alone, rest, strict=True)]

    def _starts(self, text: str, base: int) -> tuple[list[int], dict[int, int], int]:
        """Pre-token starts (positions in the whole text), tokens before each of them, all tokens."""
        e = self.lib.encode(text, add_special_tokens=False)
        starts, before, last = [], {}, object()
        for i, (word, (at, _)) in enumerate(zip(e.word_ids, e.offsets, strict=True)):
            if word != last or word is None:
                # the library trims a leading space from offsets: the pre-token starts before it
                begin = at - 1 if at and text[at - 1] == " " and word is not None else at
                if base + begin not in before:
                    starts.append(base + begin)
                    before[base + begin] = i
                last = word
        return starts, before, len(e)

    def count(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        """Tokens of a text of any length."""
        n = len(text)
        if n <= chunk:
            return self.short([text])[0]
        start, end, at, total = 0, chunk, 0, 0
        starts, before, size = self._starts(text[:end], 0)
        # ``at``: the true boundary from which this chunk's tokens count; start <= at
        while end < n:
            wide = overlap
            while True:
                nxt = max(end - MARGIN - wide, at)
                stop = min(n, nxt + chunk + wide)
                if nxt == at:  # widened back to a true boundary: the chunk is redone from there, longer
                    start, end = at, min(n, at + chunk + 2 * wide)
                    starts, before, size = self._starts(text[start:end], start)
                    break
                s2, b2, z2 = self._starts(text[nxt:stop], nxt)
                common = [p for p in s2 if nxt < p < end - MARGIN and p > at and p in before]
                if common:
                    p = common[-1]
                    total += before[p] - before[at]
                    start, end, at, starts, before, size = nxt, stop, p, s2, b2, z2
                    break
                wide *= 2
            if nxt == at and end < n:
                # the longer chunk must have a true boundary before it can be left; else grow again
                overlap_now = wide
                while end < n and not any(at < p < end - MARGIN for p in starts):
                    overlap_now *= 2
                    end = min(n, at + chunk + 2 * overlap_now)
                    starts, before, size = self._starts(text[at:end], at)
        return total + size - before[at]


def built(table: bytes) -> Counter:
    """One for each worker process and table."""
    return kept("tokencount", hash(table), len(table), build=lambda: Counter(table))


def count_tokens(docs: DataFrame, tokenizer_path: str, *, limit: int = 512, chunk: int = CHUNK, overlap: int = OVERLAP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` of every whole text, without a shuffle.

    Texts of up to ``chunk`` characters are counted in batches; longer ones chunk by chunk, so
    memory is bounded by the chunk, not by the document.
    A null text counts as empty (0 bytes, 0 tokens); null ids and repeated rows stay;
    other columns are ignored; an empty table gives an empty result.
    """
    table = docs.sparkSession.sparkContext.broadcast(file_bytes(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = built(table.value)
        for batch in text_blocks(batches, 1 << 20):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            short = iter(counter.short([x for x in texts if len(x) <= chunk]))
            counts = [next(short) if len(x) <= chunk else counter.count(x, chunk, overlap) for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_bytes"), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    given = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    out = given.mapInArrow(run, schema)
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
