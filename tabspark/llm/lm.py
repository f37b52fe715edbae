"""Language-model scoring with a weighted backoff automaton.

States are contexts: the empty one, the beginning of a text, every word, every pair of words
and so on up to ``order - 1`` words. A state has an arc for every word seen after it in
training, weighted with the log-probability of the smoothed n-gram, that leads to the state
of the longer context; and one failure arc to the state without the first word, weighted with
the log of the mass left over. The empty state has an arc for every word. Smoothing is
Dirichlet: with c(hw) and c(h) counted over the training documents, p(w|h) =
(c(hw) + mu p(w|h')) / (c(h) + mu), and p(w) = (c(w) + 1) / (N + V + 1). A text is read once
from left to right: its state is carried along, and at each token the word's arc is taken, or
failure arcs until there is one; their weights add up to the score.

The model is never in one place. Documents are cut into blocks of bounded size, written as
word numbers over the block's own vocabulary. Each block asks for the n-grams that occur in
it: sorted hashes with the block's own training counts, cut into hash ranges. A task holds
one range of all blocks, sums the counts and answers every block in the order of its
question. So a block's answers are exactly the states and arcs that its traversal can reach.
An n-gram occurs at most once in a block's question, however frequent it is, so a range has
about ``RANGE`` entries and at most one more for each block from a common n-gram.
What is shuffled grows with the corpus: there are no cut-offs.

Words are compared by 64-bit hashes. Longer n-grams are compared by so many bits that one
asked for in vain meets a counted one with probability 2 to the power -``SPARE`` at most
(64 bits at most, so from about 10**12 n-grams on that grows).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, LOWER, expand, kept, materialize, mix, squeeze, text_blocks, text_bytes

#: Longest n-gram; pseudo-counts of the shorter context, for contexts of one word, two words, ...
ORDER, MU = 3, (100.0, 10.0)
#: n-grams of a hash range, about; bits of a hash beyond those that number the n-grams.
RANGE, SPARE = 2_000_000, 20
#: Bytes of text of a block: what a task holds of the model is a small multiple.
BLOCK = BLOCK_BYTES // 2
#: Partitions of the exchange of questions at most: a task answers its ranges one by one.
PARTS = 20_000
#: Hashes of the end of a text and of what stands before its first word.
END, BEGIN = 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3


def _blocks(docs: DataFrame) -> DataFrame:
    """``block, ids, train, lengths, vocabulary, sequence`` and three counts: documents as word numbers, in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("lm")
        import xxhash
        from pyspark import TaskContext

        seq, task = 0, TaskContext.get().partitionId()
        parts: list[pa.RecordBatch] = []
        held = 0

        def block() -> pa.RecordBatch:
            nonlocal seq, held, parts
            numbers: dict[bytes, int] = {}
            flat, lengths = [], []
            for part in parts:
                for x in text_bytes(part):
                    words = x.translate(LOWER).split()
                    lengths.append(len(words))
                    flat += [numbers.setdefault(w, len(numbers)) for w in words]
            vocabulary = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))
            ids = pa.concat_arrays([p.column("id") for p in parts])
            train = np.concatenate([p.column("train").to_numpy(zero_copy_only=False) for p in parts]).astype(bool)
            n_train = int((np.array(lengths, "i8")[train] + 1).sum())
            out = pa.RecordBatch.from_arrays(
                [pa.array([task << 32 | seq], pa.int64()), pa.ListArray.from_arrays([0, len(ids)], ids), pa.array([train.astype("u1").tobytes()]), pa.array([squeeze(np.array(lengths, "<u4"))]), pa.array([vocabulary.tobytes()]), pa.array([squeeze(np.array(flat, "<u4"))]), *[pa.array([x], pa.int64()) for x in (n_train, int(train.sum()), len(flat))]],
                ["block", "ids", "train", "lengths", "vocabulary", "sequence", "n_train", "n_texts", "n_words"],
            )
            seq, held, parts = seq + 1, 0, []
            return out

        for part in text_blocks(batches, BLOCK):
            parts.append(part)
            held += part.column("text").nbytes
            if held >= BLOCK:
                yield block()
        if parts:
            yield block()

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"block long, ids array<{kind}>, train binary, lengths binary, vocabulary binary, sequence binary, n_train long, n_texts long, n_words long")


class Grams:
    """The n-grams of a block: for each order the distinct hashes, and which of them ends at each token.

    An n-gram reaches back to the mark of the beginning at most: at the first tokens of a
    text there is none of the higher orders (-1).
    """

    def __init__(self, lengths: bytes, vocabulary: bytes, sequence: bytes, order: int, bits: int):
        words = expand(lengths, "<u4").astype("i8")
        self.sizes = words + 1  # with the end
        self.starts = np.cumsum(self.sizes) - self.sizes
        total = int(self.sizes.sum())
        known = np.append(np.frombuffer(vocabulary, "<u8"), np.uint64(END))
        self.words = len(known) - 1
        inner = np.ones(total, bool)
        inner[self.starts + words] = False
        self.token = np.full(total, self.words, "i4")
        self.token[inner] = expand(sequence, "<u4")
        first = np.zeros(total, bool)
        first[self.starts] = True
        self.distinct, self.place, self.where = [], [], []
        place = np.arange(total) - np.repeat(self.starts, self.sizes)  # of a token in its text
        single = hashes = mix(known + np.uint64(1))[self.token]
        for n in range(1, order + 1):
            if n > 1:
                # an n-gram is the (n-1)-gram that ends one token earlier and this token
                before = np.empty_like(hashes)
                before[1:] = hashes[:-1]
                before[first] = np.uint64(BEGIN)
                hashes = mix(before * np.uint64(0x9E3779B97F4A7C15) + single + np.uint64(n))
            valid = np.flatnonzero(place >= n - 2)
            short = hashes[valid] if n == 1 else hashes[valid] >> np.uint64(64 - bits)
            distinct, back = np.unique(short, return_inverse=True)
            here = np.full(total, -1, "i4")
            here[valid] = back
            ends = np.empty(len(distinct), valid.dtype)
            ends[back] = valid
            self.distinct.append(distinct)
            self.place.append(here)
            self.where.append(ends)  # a token at which each distinct n-gram ends


def _cuts(bits: int, ranges: int) -> np.ndarray:
    """Range r holds the hashes h of so many bits with h * ranges >> bits == r."""
    return np.array([-(-(r << bits) // ranges) for r in range(1, ranges)], np.uint64)


def _questions(blocks: DataFrame, order: int, bits: int, ranges: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("lm")
        names = ["range", "block", "gram", "hashes", "counts"]
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
        for batch in batches:
            for row in batch.to_pylist():
                grams = Grams(row["lengths"], row["vocabulary"], row["sequence"], order, bits)
                train = np.repeat(np.frombuffer(row["train"], "u1"), grams.sizes).astype(bool)
                for n, (h, at) in enumerate(zip(grams.distinct, grams.place, strict=True), 1):
                    counts = np.bincount(at[train & (at >= 0)], minlength=len(h)).astype("<u4")
                    edges = [0, *np.searchsorted(h, _cuts(64 if n == 1 else bits, ranges)).tolist(), len(h)]
                    some = [(r, s, e) for r, (s, e) in enumerate(zip(edges, edges[1:], strict=False)) if e > s]
                    for at_ in range(0, len(some), 256):
                        part = some[at_ : at_ + 256]
                        columns = [[r for r, _, _ in part], [row["block"]] * len(part), [n] * len(part), [squeeze(np.diff(h[s:e], prepend=np.uint64(0))) for _, s, e in part], [squeeze(counts[s:e]) for _, s, e in part]]
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    given = blocks.select("block", "train", "lengths", "vocabulary", "sequence")
    return given.mapInArrow(run, "range int, block long, gram int, hashes binary, counts binary")


def _answers(questions: DataFrame, ranges: int) -> DataFrame:
    """``block, gram, range, answer``, aligned with the questions; and a row of block null with V's part."""

    def reply(rows: list[dict]) -> pa.RecordBatch:
        out, known = [None] * (len(rows) + 1), 0
        # the hash of an n-gram depends on n only by its making: orders are summed apart
        for n in sorted({r["gram"] for r in rows}):
            mine = [i for i, r in enumerate(rows) if r["gram"] == n]
            parts = [np.cumsum(expand(rows[i]["hashes"], "<u8"), dtype=np.uint64) for i in mine]
            counts = np.concatenate([expand(rows[i]["counts"], "<u4") for i in mine])
            _, at = np.unique(np.concatenate(parts), return_inverse=True)
            total = np.bincount(at, counts).astype("<u8")
            if n == 1:
                known = int((total > 0).sum())
            edges = np.cumsum([0, *map(len, parts)]).tolist()
            for i, s, e in zip(mine, edges, edges[1:], strict=False):
                out[i] = squeeze(total[at[s:e]])
        return pa.RecordBatch.from_arrays(
            [pa.array([*[r["block"] for r in rows], None], pa.int64()), pa.array([*[r["gram"] for r in rows], 0], pa.int32()), pa.array([rows[0]["range"]] * len(out), pa.int32()), pa.array(out, pa.binary()), pa.array([None] * len(rows) + [known], pa.int64())],
            ["block", "gram", "range", "answer", "known"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("lm")
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["range"] != held[0]["range"]:
                    yield reply(held)
                    held = []
                held.append(row)
        if held:
            yield reply(held)

    parts = min(ranges, PARTS)
    dealt = questions.repartitionById(parts, F.pmod("range", F.lit(parts)).cast("int")).sortWithinPartitions("range")
    return dealt.mapInArrow(run, "block long, gram int, range int, answer binary, known long")


class Automaton:
    """The part of the automaton that a block can reach, over the block's own numbers of words and n-grams.

    State 0 is the empty context, 1 + w the word w, 1 + ``words`` the beginning; then come the
    longer contexts, by the number of their n-gram. An arc belongs to the n-gram of its state's
    words and its own: ``arcs`` has for each depth of a state and each token of the block the arc
    of that token from the state of that depth before it (-1: none).
    """

    def __init__(self, grams: Grams, counts: list[np.ndarray], tokens: int, vocabulary: int, texts: int, mu: Sequence[float]):
        self.order, kinds = len(counts), grams.words + 1  # with the end
        starting = np.zeros(len(grams.token), bool)
        starting[grams.starts] = True
        p = (counts[0] + 1.0) / (tokens + vocabulary + 1.0)
        by_word = np.zeros(kinds, "i8")  # number of the 1-gram of a word
        by_word[grams.token] = grams.place[0]
        self.root = np.log10(p)[by_word]
        self.begin = 1 + grams.words
        base = [None, 1, 2 + grams.words]  # first state of each depth
        for n in range(2, self.order):
            base.append(base[-1] + len(grams.where[n - 1]))
        states = base[self.order] if self.order > 1 else 1
        self.fail, self.fail_weight = np.zeros(states, "i4"), np.zeros(states)
        weights, targets, self.arcs = [], [], [None]

        def state(n: int, token: np.ndarray) -> np.ndarray:
            """The state of the n words that end at a token."""
            return 1 + grams.token[token] if n == 1 else base[n] + grams.place[n - 1][token]

        seen = counts[0][by_word]
        for n in range(2, self.order + 1):
            at = grams.where[n - 1]
            start, m = starting[at], mu[min(n - 2, len(mu) - 1)]
            if n == 2:
                context = np.where(start, texts, seen[grams.token[at - 1]]).astype("f8")
                self.fail_weight[1 : 2 + grams.words] = np.log10(m / (np.append(seen[: grams.words], texts) + m))
            else:
                context = counts[n - 2][grams.place[n - 2][at - 1]].astype("f8")
            count = counts[n - 1].astype("f8")
            p = (count + m * p[grams.place[n - 2][at]]) / (context + m)
            there = np.flatnonzero(count > 0)
            number = np.full(len(count) + 1, -1, "i4")  # the last one stands for no n-gram
            number[there] = sum(map(len, weights)) + np.arange(len(there))
            self.arcs.append(number[grams.place[n - 1]])
            weights.append(np.log10(p[there]))
            targets.append(state(min(n, self.order - 1), at[there]).astype("i4"))
            if n < self.order:  # these n-grams are contexts themselves
                mine = slice(base[n], base[n] + len(count))
                self.fail[mine] = state(n - 1, at)
                self.fail_weight[mine] = np.log10(mu[min(n - 1, len(mu) - 1)] / (count + mu[min(n - 1, len(mu) - 1)]))
        self.weight = np.concatenate(weights) if weights else np.zeros(0)
        self.target = np.concatenate(targets) if targets else np.zeros(0, "i4")

    def scores(self, token: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The score of every text: each is read once from its first token to its end, with its state carried along."""
        # single items of a memoryview come as plain numbers, without a copy of the table
        words, root, weight, target, fail, fail_weight = map(memoryview, (token, self.root, self.weight, self.target, self.fail, self.fail_weight))
        arcs, top = [None, *map(memoryview, self.arcs[1:])], self.order - 1
        out = np.zeros(len(starts))
        for i, (start, size) in enumerate(zip(starts.tolist(), sizes.tolist(), strict=True)):
            state, depth, total = (self.begin, 1, 0.0) if top else (0, 0, 0.0)
            for t in range(start, start + size):
                while depth:
                    arc = arcs[depth][t]
                    if arc >= 0:
                        total += weight[arc]
                        state = target[arc]
                        if depth < top:
                            depth += 1
                        break
                    total += fail_weight[state]
                    state = fail[state]
                    depth -= 1
                else:
                    w = words[t]
                    total += root[w]
                    if top:
                        state, depth = 1 + w, 1
            out[i] = total
        return out


def _scored(blocks: DataFrame, answers: DataFrame, kind: str, order: int, bits: int, mu: Sequence[float], tokens: int, vocabulary: int, texts: int) -> DataFrame:
    def reduce(table: pa.Table) -> pa.Table:
        whole = [r for r in table.select(["ids", "train", "lengths", "vocabulary", "sequence"]).to_pylist() if r["sequence"] is not None][0]
        ids = table.column("ids").combine_chunks().flatten()
        grams = Grams(whole["lengths"], whole["vocabulary"], whole["sequence"], order, bits)
        grams.distinct = None  # only their numbers matter from here on
        gram, which, answer = table.column("gram").to_pylist(), table.column("range").to_pylist(), table.column("answer")
        counts = []
        for n in range(1, order + 1):
            rows = sorted((r, i) for i, (g, r) in enumerate(zip(gram, which, strict=True)) if g == n)
            parts = [expand(answer[i].as_py(), "<u8").astype("i8") for _, i in rows]
            counts.append(np.concatenate(parts) if parts else np.zeros(0, "i8"))
        c = counts[0]
        base = np.log10((c + 1.0) / (tokens + 1.0 * (vocabulary + 1.0)))[grams.place[0]]
        score = Automaton(grams, counts, tokens, vocabulary, texts, mu).scores(grams.token, grams.starts, grams.sizes)
        known = (c > 0)[grams.place[0]].astype("i8")
        add = lambda x: np.add.reduceat(x, grams.starts) if len(grams.starts) else x
        train = np.frombuffer(whole["train"], "u1").astype(bool)
        return pa.Table.from_arrays([ids, pa.array(~train), pa.array(grams.sizes, pa.int64()), pa.array(add(known), pa.int64()), pa.array(add(base)), pa.array(score)], ["id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    empty = lambda t: F.lit(None).cast(t)
    left = blocks.select("block", "ids", "train", "lengths", "vocabulary", "sequence", empty("int").alias("gram"), empty("int").alias("range"), empty("binary").alias("answer"))
    right = answers.where("block IS NOT NULL").select("block", empty(f"array<{kind}>").alias("ids"), *[empty("binary").alias(c) for c in ("train", "lengths", "vocabulary", "sequence")], "gram", "range", "answer")
    schema = f"id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    return left.union(right).groupBy("block").applyInArrow(reduce, schema)


def score(docs: DataFrame, *, order: int = ORDER, mu: Sequence[float] = MU, folds: int = 7, held_out: int = 2, id_col: str = "doc_id", text_col: str = "text", range_size: int = RANGE) -> DataFrame:
    """``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``.

    Training rows are those whose crc32(id as text) mod ``folds`` is not ``held_out``; a null
    id counts as empty text. Tokens are words, A-Z lower-cased, and one end for each text; a
    null or empty text is its end alone. Repeated rows are counted and scored each. Without
    any training row all counts are 0. ``mu`` has a pseudo-count for each context length, the
    last one for all longer ones. Other columns are ignored, whatever their names; an empty
    table gives an empty result.
    """
    fold = F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % folds
    given = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), (fold != held_out).alias("train"))
    kind = given.schema["id"].dataType.simpleString()
    blocks = materialize(_blocks(given), "lm-blocks")
    tokens, texts, sized = blocks.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_train", "n_texts", "n_words")]).first()
    grams = int(sized + texts + 1) * order
    bits = min(64, grams.bit_length() + SPARE)
    ranges = max(8, grams // range_size)
    answers = materialize(_answers(_questions(blocks, order, bits, ranges), ranges), "lm-answers")
    vocabulary = answers.agg(F.coalesce(F.sum("known"), F.lit(0))).first()[0]
    out = _scored(blocks, answers, kind, order, bits, mu, int(tokens), int(vocabulary), int(texts))
    return out.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(int(tokens)).cast("long").alias("train_tokens"), "base_score", "score")
