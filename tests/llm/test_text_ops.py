from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import math
import pytest
from pyspark.sql import functions as F

from tabspark.llm import chat, decontam, jaccard, lm, pii, quality, rtree, secrets
from tabspark.llm.components import components

from .helpers import ODD, docs, key, texts

LOWER = {c: c + 32 for c in range(65, 91)}
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(n: int = 60, seed: int = 5) -> list[tuple]:
    r = random.Random(seed)
    vocabulary = ["the", "of", "and", "Ünder", "naïve"] + ["w%d" % i for i in range(200)]
    base = [[r.choice(vocabulary) for _ in range(r.choice([4, 8, 60, 120]))] for _ in range(n)]
    rows = []
    for i, words in enumerate(base):
        rows.append((1000 + i, " ".join(words), "en", "s%d" % (i % 3), 1))
        if i % 4 == 0:
            rows.append((2000 + i, " ".join(words).upper(), "en", "s0", 1))
        if i % 5 == 0:
            near = list(words)
            for _ in range(1 + i % 3):
                near[r.randrange(len(near))] = "edit%d" % i
            rows.append((3000 + i, " ".join(near), "de", "s1", 1))
    return rows + ODD


# ---- quality ----------------------------------------------------------------------------


def base_stats(text: str):
    words = WORDS.findall(text)
    grams = defaultdict(list)
    for i in range(len(words) - 2):
        grams[tuple(words[i : i + 3])].append(i)
    covered = {p + d for at in grams.values() if len(at) > 1 for p in at for d in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def mcd(rows, estimates=None):
    """Brute force of the estimate: (lang, source, stats) rows to verdicts; ``estimates`` takes group -> log determinant."""
    import numpy as np

    def vector(s):
        w = max(s[0], 1)
        raw = [math.log(max(s[1], 1) / w), math.log1p(100 * s[2] / w), s[4] / w, 10 * s[3] / w, math.log(w)]
        return [int(math.floor(abs(x * quality.UNIT) + 0.5) * (1 if x >= 0 else -1)) for x in raw]

    failed = lambda s: s[0] < 50 or 100 * s[4] > 50 * s[0]
    name = lambda x: "null" if x is None else "=" + x
    group = lambda a, b: name(a) + "\t" + name(b)
    data = defaultdict(list)
    for a, b, s in rows:
        if not failed(s):
            data[group(a, b)].append(vector(s))
    floors = np.array(list(quality.FEATURES.values())) * quality.UNIT
    est = {}

    def cut(bins, share):
        need, total = math.ceil(len(bins) * share), 0
        for b, c in sorted(Counter(bins).items()):
            total += c
            if total >= need:
                return b

    def of(core):
        mean = core.mean(axis=0)
        weight = len(core) / (len(core) + quality.SHRINK) * quality.CONSISTENCY
        k = np.linalg.cholesky((core.T @ core / len(core) - np.outer(mean, mean)) * weight + np.diag(floors**2))
        return mean, np.linalg.inv(k), 2 * np.log(np.diag(k)).sum()

    for g, xs in data.items():
        x = np.array(xs, float)
        bins = [[math.floor(v / quality.BIN) for v in x[:, j]] for j in range(x.shape[1])]
        median = np.array([(cut(b, 0.5) + 0.5) * quality.BIN for b in bins])
        scale = np.array([max((cut(b, 0.75) - cut(b, 0.25)) * quality.BIN / 1.349, f) for b, f in zip(bins, floors, strict=True)])
        tried = []
        for n, (mean, inverse) in enumerate([(median, np.diag(1 / scale)), of(x)[:2], (median, np.diag(1 / floors))]):
            last = math.inf
            while True:
                d = (((x - mean) @ inverse.T) ** 2).sum(axis=1)
                far = np.array([math.floor(math.log(v + 1e-6) * quality.FINE) for v in d])
                mean, inverse, logdet = of(x[far <= cut(far.tolist(), quality.CORE)])
                tried.append((logdet, n, mean, inverse))
                if logdet >= last - quality.TOLERANCE:
                    break
                last = logdet
        logdet, _, mean, inverse = min(tried, key=lambda e: e[:2])
        est[g] = mean, inverse
        if estimates is not None:
            estimates[g] = logdet
    out = []
    for a, b, s in rows:
        found = est.get(group(a, b))
        d = None if found is None else float((((np.array(vector(s)) - found[0]) @ found[1].T) ** 2).sum())
        out.append((failed(s), not failed(s) and (d is None or d <= quality.CUTOFF)))
    return out


def quality_rows():
    r = random.Random(9)
    rows = list(ODD)
    for i in range(160):
        words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 9))) for _ in range(r.randint(40, 120))]
        if i % 17 == 0:
            words = [w + "***" for w in words]
        if i % 19 == 0:
            words = words[:9] * 12
        text = "\n".join(" ".join(words[j : j + 12]) for j in range(0, len(words), 12))
        rows.append((100 + i, text + ("\n" + text if i % 23 == 0 else ""), r.choice(["en", "de", None]), r.choice(["a", "b"]), 1))
    return rows


def test_quality(spark):
    rows = quality_rows()
    # groups of one and of three rows: the rule is the same
    rows += [(300, rows[20][1], "xx", "a", 1), *[(301 + i, rows[21 + i][1], "xx", "b", 1) for i in range(3)]]
    got = quality.score(docs(spark, rows)).collect()
    stats = [base_stats(r[1] or "") for r in rows]
    want = [(r[0], *s, *v) for r, s, v in zip(rows, stats, mcd([(r[2], r[3], s) for r, s in zip(rows, stats, strict=True)]), strict=True)]
    names = ["doc_id", *quality.STATS, "base_failed", "kept"]
    assert sorted((tuple(g[c] for c in names) for g in got), key=key) == sorted(want, key=key)
    assert any(not w[-1] and not w[-2] for w in want)
    least = {}
    mcd([(r[2], r[3], s) for r, s in zip(rows, stats, strict=True)], least)
    frame = quality.with_stats(docs(spark, rows).drop("n_words")).select("lang", "source", "_s.*")
    found = {r.g: r.logdet for r in quality.fit(frame).collect()}
    assert found == pytest.approx(least, rel=1e-9) and len(found) == len(least)
    kept = quality.keep_good(docs(spark, rows)).collect()
    assert sorted((k.doc_id for k in kept), key=str) == sorted((w[0] for w in want if w[-1]), key=str)
    assert quality.score(docs(spark).limit(0)).count() == 0 and quality.keep_good(docs(spark).limit(0)).count() == 0


# ---- near duplicates --------------------------------------------------------------------


def brute_components(rows):
    sets = []
    for i, text in rows:
        w = WORDS.findall(text.translate(LOWER))
        sets.append((i, frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])))
    up = list(range(len(sets)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                up[find(a)] = find(b)
    least = {}
    for n, (i, _) in enumerate(sets):
        if i is not None:
            least[find(n)] = min(least.get(find(n), i), i)
    return [(i, len(s), least.get(find(n))) for n, (i, s) in enumerate(sets)]


@pytest.mark.parametrize("seed", [5, 6])
def test_jaccard(spark, seed, monkeypatch):
    rows = corpus(seed=seed)
    got = [tuple(r) for r in jaccard.join(docs(spark, rows)).collect()]
    assert sorted(got, key=key) == sorted(brute_components(texts(rows)), key=key)


@pytest.mark.parametrize("size", [jaccard.LIST, 5])
def test_jaccard_in_blocks(spark, monkeypatch, size):
    monkeypatch.setattr(jaccard, "LIST", size)  # lists in one piece, and all cut into parts
    monkeypatch.setattr(jaccard, "CELL", 4)
    monkeypatch.setattr(jaccard, "SPREAD", 1)
    monkeypatch.setattr(jaccard, "SHARE", 20)
    monkeypatch.setattr(jaccard, "VOTES", 1000)  # all is left to the complete step
    # from 60 to 147 words: over several bands of sizes
    rows = [(i, " ".join(["w%d" % j for j in range(60 + 3 * i)] + ["x%d" % (i // 3)]), "en", "a", 1) for i in range(30)]
    got = [tuple(r) for r in jaccard.join(docs(spark, rows)).collect()]
    assert sorted(got) == sorted(brute_components(texts(rows)))


def test_one_of_each(spark):
    rows = corpus()
    left = jaccard.one_of_each(docs(spark, rows).withColumns({x: F.lit(1) for x in ("_c", "_r", "_id", "_row", "_t", "_gone", "_again")})).collect()
    named = {c for _, _, c in brute_components(texts(rows))}
    assert {r.doc_id for r in left} == named and len(left) == len(named)
    assert jaccard.one_of_each(docs(spark).limit(0)).count() == 0


def test_rtree_is_complete():
    import numpy as np

    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 62, 400).astype("u8")
    sets = [np.unique(np.concatenate([base[: r.integers(20, 200)], r.integers(0, 1 << 62, r.integers(1, 60)).astype("u8")])) for _ in range(150)]
    points, sizes = rtree.points_of([rtree.point(s) for s in sets]), np.array([len(s) for s in sets])
    tree = rtree.RTree(points, sizes)
    for i, s in enumerate(sets):
        true = {j for j, t in enumerate(sets) if rtree.overlap(s, t) >= rtree.needed(len(s), len(t), 75)}
        assert true <= set(tree.search(points[i], len(s), 75).tolist())


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 120), (120, 110), (7, 7)]
    got = {(r.node, r.root) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(i, 1) for i in range(1, 41)} | {(i, 100) for i in (100, 110, 120)}


# ---- decontamination --------------------------------------------------------------------


def test_decontamination(spark):
    rows = corpus(30)
    source = rows[0][1].split() * 3
    items = [(1, " ".join(source[3:30])), (2, "One, TWO three"), (10, None), (11, ""), (3, rows[5][1]), (None, "no id here"), (2, "one two three"), (4, "the"), (12, "not there at all")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    split = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (x or "").translate(LOWER))
    want = []
    for i, text in texts(rows):
        w, hit, found = split(text), set(), set()
        for name, item in items:
            v = split(item)
            n = min(10, len(v))
            for j in range(len(v) - n + 1 if n else 0):
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == v[j : j + n]:
                        hit.update(range(p, p + n))
                        found.add("null" if name is None else str(name))
        want.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    for hot in (decontam.HOT, 2):  # all prefix shingles in one task each, and dealt to several
        got = [tuple(r) for r in decontam.report(docs(spark, rows), benchmark, hot=hot).collect()]
        assert sorted(got, key=key) == sorted(want, key=key)
    clean = decontam.clean(docs(spark, rows), benchmark)
    assert clean.columns == docs(spark).columns and clean.count() == sum(not w[-1] for w in want)
    assert decontam.report(docs(spark, rows), benchmark.limit(0)).where("contaminated").count() == 0
    assert decontam.report(docs(spark).limit(0), benchmark).count() == 0


# ---- secrets ----------------------------------------------------------------------------

HOT = [
    (1, 'x password = "hunter22" and token: abc then API_KEY=abcdef/123 é secret=token:abcdef', "en", "a", 1),
    (2, "AKIA" + "A1" * 8 + " AKIAshort " + "deadbeef" * 4 + " cafe", "en", "a", 1),
    (3, "é" * 5 + 'passWD:\'zzzzzz\' tokentoken=1234567 key "' + "0" * 23 + '" ' + "0" * 24, "en", "a", 1),
    (4, "ghp_" + "a1B2" * 9 + " eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.abcdefghijkl", "en", "a", 1),
    (5, 'x password = "hunter22" and token: abc then API_KEY=abcdef/123 é secret=token:abcdef', "en", "a", 1),
    (6, "ghp_abcghp_" + "a1B2" * 10 + " AKIAAKIA" + "Z9" * 8, "en", "a", 1),
]


def brute_secrets(text: str):
    found = []
    for n, (_, p, least, group) in enumerate(secrets.RULES):
        for m in re.finditer(p, text):
            if len(m[group]) >= least:
                found.append((m.start(), n, m.end()))
    return sorted(found)


def test_secrets(spark):
    rows = HOT + ODD
    got = [tuple(r) for r in secrets.report(docs(spark, rows)).collect()]
    want = []
    for i, text in texts(rows):
        f = brute_secrets(text)
        line = lambda xs: ",".join(f"{secrets.RULES[k][0]}:{s}:{e}" for s, k, e in xs)
        want.append((i, *[sum(k == n for _, k, _ in f) for n in range(3)], hashlib.sha256(line([x for x in f if x[1] < 3]).encode()).hexdigest(), line(f)))
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sum(w[1] for w in want) >= 6
    assert secrets.report(docs(spark).limit(0)).count() == 0


def test_ledger(spark):
    first, entries = secrets.scan(docs(spark, HOT[:2]))
    assert first.count() == 2 and entries.count() == 2
    second, more = secrets.scan(docs(spark, HOT), entries)
    assert more.count() == 3  # 3, 4 and 6; 5 has the content of 1
    spans = {r.doc_id: r.spans for r in second.collect()}
    assert spans[1] == spans[5] and spans[1] and spans[3]
    assert secrets.scan(docs(spark, HOT[:2]), entries, version="other")[1].count() == 2
    # nothing new; and one new text among many known ones: the list of rows to scan is the shorter one
    assert secrets.scan(docs(spark, HOT[:2]), entries)[1].count() == 0
    whole = entries.union(more)
    third, one = secrets.scan(docs(spark, [*HOT, (7, "token = abcdefgh", "en", "a", 1), (7, "token = abcdefgh", "en", "a", 1)]), whole)
    assert one.count() == 1 and third.count() == len(HOT) + 2 and all(r.spans for r in third.where("doc_id = 7").collect())


def test_redaction(spark):
    rows = HOT + ODD
    got = {(r.doc_id, r.text) for r in secrets.redact(docs(spark, rows)).collect()}
    want = set()
    for r in rows:
        out, at = "", 0
        for s, _, e in brute_secrets(r[1] or ""):
            if e > at:
                out += (r[1][at:s] + "[SECRET]") if s >= at else ""
                at = e
        want.add((r[0], r[1] if r[1] is None else out + r[1][at:]))
    assert got == want
    assert secrets.redact(docs(spark, rows)).columns == docs(spark).columns and secrets.redact(docs(spark, rows)).count() == len(rows)


# ---- chat -------------------------------------------------------------------------------


def test_grammar_round_trip():
    r = random.Random(4)
    atoms = ["[INST]", "[/INST]", " [/INST]", "<s>", "</s>", "[ROLE x] ", " [/ROLE]", "\\", "[\\INST]", "<\\\\s>", "a", " ", "\n", "[", "]", "<", "] ", "é"]
    for _ in range(1500):
        turns = [(r.choice(["user", "assistant", "system", "", "we] ird%5D"]), "".join(r.choice(atoms) for _ in range(r.randint(0, 7)))) for _ in range(r.randint(0, 4))]
        text, mask = chat.format_turns(turns)
        assert [(a, b) for a, b, _, _ in chat.parse(text)] == turns
        assert [chat.unescape(text[s:e]) for s, e in mask] == [b for a, b in turns if a == "assistant"]


def test_chat_query(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (2, 0, None, "x"), (None, 0, "user", "</s>"), (1, 1, "assistant", "a"), (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"), (3, None, "assistant", "")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1)).withColumn("mask", F.lit(1))
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(frame)).collect()}
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert got[1].n_turns == 3 and got[1].loss_sha256 == digest("ab") and got[1].turns_sha256 == digest("user\n\nassistant\na\nassistant\nb\n")
    assert got[-7].loss_chars == 21 and got[-7].loss_sha256 == digest("</s>[INST] ok [/INST]")
    assert got[2].turns_sha256 == digest("\nx\n") and got[3].loss_chars == 0 and got[None].n_turns == 1
    assert chat.read_back(chat.format_conversations(frame.limit(0))).count() == 0


# ---- language model -----------------------------------------------------------------------


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_backoff_scores(spark, order, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK", 4000)  # several blocks, and texts larger than one
    rows = [*corpus(25), (5000, "the of and w1 " * 1500, "en", "a", 1)]
    mu = (3.0, 2.0)
    got = sorted(map(tuple, lm.score(docs(spark, rows), order=order, mu=mu, range_size=50).collect()), key=key)
    end, begin = object(), object()
    fold = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7
    tokens = [(i, WORDS.findall(x.translate(LOWER)) + [end]) for i, x in texts(rows)]
    counts, texts_ = Counter(), 0
    for i, w in tokens:
        if fold(i) != 2:
            texts_ += 1
            x = [begin, *w]
            for n in range(1, order + 1):
                counts.update(tuple(x[j - n + 1 : j + 1]) for j in range(1, len(x)) if j - n + 1 >= 0)
    total = sum(c for g, c in counts.items() if len(g) == 1)
    vocabulary = sum(len(g) == 1 for g in counts)
    want = []
    for i, w in tokens:
        x, base, score = [begin, *w], 0.0, 0.0
        for j in range(1, len(x)):
            p = (counts[(x[j],)] + 1) / (total + vocabulary + 1)
            base += math.log10(p)
            for n in range(2, order + 1):
                if j - n + 1 >= 0:
                    h = tuple(x[j - n + 1 : j])
                    m = mu[min(n - 2, 1)]
                    p = (counts[(*h, x[j])] + m * p) / ((texts_ if h == (begin,) else counts[h]) + m)
            score += math.log10(p)
        want.append((i, fold(i) == 2, len(w), sum(counts[(t,)] > 0 for t in w), total, base, score))
    want.sort(key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)
    assert lm.score(docs(spark).limit(0)).count() == 0


# ---- personal data -------------------------------------------------------------------------


def test_surrogates(spark):
    rows = [
        (11, "Mail Bob.42@Mail3.example.com or +1 (459) 555-9246, 459-555-9246; ip 10.0.0.1. cards 4111 1111 1111 1111, 4111111111111111 and 4111111111111112.", "en", "a", 1),
        (12, "Mr. John Smith met Frau Anna Schmidt and Mr Smith; Госпожа Анна Иванова. 123-45-6789", "en", "a", 1),
        (13, "bob.42@mail3.example.com x BOB.42@MAIL3.EXAMPLE.COM", "en", "a", 1),
        (13, "bob.42@mail3.example.com x BOB.42@MAIL3.EXAMPLE.COM", "en", "a", 1),
        (14, "v1.2.3.4.5 on 2024-01-01 12:30, 3 of 4", "en", "a", 1),
        *ODD,
    ]
    out = pii.replace(docs(spark, rows), "key")
    got = out.collect()
    assert out.columns == [*docs(spark).columns, "n_entities"] and len(got) == len(rows)
    by = {(r.doc_id, r.n_entities): r.text for r in got}
    one, two, three = (next(t for (i, _), t in by.items() if i == n) for n in (11, 12, 13))
    for real in ("Bob", "459", "9246", "10.0.0.1", "4111 1111", "1111111111111111", "John", "Smith", "Anna", "Schmidt", "Анна", "Иванова", "123-45"):
        assert real not in one + two + three
    assert one.split()[1].lower() == three.split()[0]  # coreference over texts and case
    assert re.search(r"\+1 \((\d{3})\) (\d{3}-\d{4}), \1-\2", one)
    grouped, plain, invalid = re.search(r"cards (\d{4} \d{4} \d{4} \d{4}), (\d{16}) and (\d{16})\.", one).groups()
    luhn = lambda s: sum(int(d) if i % 2 == 0 else (int(d) * 2 - 9 if int(d) > 4 else int(d) * 2) for i, d in enumerate(reversed(s))) % 10 == 0
    assert grouped.replace(" ", "") == plain and luhn(plain) and not luhn(invalid)
    m = re.fullmatch(r"Mr\. (\w+) (\w+) met Frau (\w+) (\w+) and Mr (\w+); Госпожа (\w+) (\w+)\. \d{3}-\d{2}-\d{4}", two)
    assert m[2] == m[5] and m[1] in pii.GIVEN["m"] and m[3] in pii.GIVEN["f"] and m[6] in pii.GIVEN["fc"]
    untouched = {r[1] for r in rows if r[0] in (14, 5, 6, 7)}
    assert untouched <= {r.text for r in got}
    assert pii.replace(docs(spark).limit(0), "key").count() == 0


def test_distinct_surrogates(spark, monkeypatch):
    monkeypatch.setitem(pii.SYLLABLES, "", ["ba", "do"])  # 16 names for 12 entities: collisions are certain
    names = spark.createDataFrame([("family", "name%d" % i) for i in range(12)], "kind string, canon string")
    done = pii.mapping(names, "k")
    out = done.select("canon", "attempt", pii.render(F.col("kind"), F.col("canon"), F.col("canon"), F.col("attempt"), "k").alias("s")).collect()
    assert len({r.s for r in out}) == 12 and any(r.attempt for r in out)


def test_persons(spark):
    given = pii.GIVEN["m"] + ["Given" + x for x in "abcdefghij"]
    lines = [f"Mr {g} Smith" for g in given] + ["Dr Anna Schmidt", "Frau Anna Schmidt", "Dr. Anna Schmidt", "Mr Kim Lee", "Ms Kim Lee", "Mr Smith"]
    out = {r.doc_id: r.text for r in pii.replace(docs(spark, [(i, x, "en", "a", 1) for i, x in enumerate(lines)]), "corpus-release-1").collect()}
    names = [out[i].split()[1:] for i in range(len(lines))]
    n = len(given)
    assert len({x[0] for x in names[:n]}) == n and {x[1] for x in names[:n]} == {names[-1][0]}
    assert not {x[0] for x in names[:n]} & set(given)  # nobody has the name of a real person
    assert names[n] == names[n + 1] == names[n + 2] and names[n][0] in pii.GIVEN["f"]
    assert names[n + 3][0] in pii.GIVEN["m"] and names[n + 4][0] in pii.GIVEN["f"]


def test_full_spaces(spark, monkeypatch):
    monkeypatch.setitem(pii.SYLLABLES, "", ["ba"])  # one name of each length
    letters = "abcdefghijklmnopqrstuvwxyz"
    locals_ = [*letters, *[a + b for a in letters for b in letters][:300]]  # 16 and 256 places
    rows = [("email", x + "@mail.example") for x in locals_] + [("family", x) for x in ("smith", "jones")]
    done = pii.mapping(spark.createDataFrame(rows, "kind string, canon string"), "corpus-release-1")
    out = done.select("kind", "canon", pii.render(F.col("kind"), F.col("canon"), F.col("canon"), F.col("attempt"), "corpus-release-1").alias("s")).collect()
    assert {(r.kind, r.canon) for r in out} == set(rows) and len({(r.kind, r.s) for r in out}) == len(rows)
    assert not {r.s for r in out} & {r.canon for r in out}


PEOPLE = [
    "Dr Γιώργος Παπαδόπουλος και Κυρία Ελένη Νικολάου",
    "السيد أحمد منصور و السيدة ليلى حداد",
    "昨天王小明先生和李娜女士来了",
    "Herr Müller-Lüdenscheidt met John O'Brien and Mary Jones; Mary Jones left, Dr John Smith stayed. JOHN SMITH",
    "call 4595559246 or +1 (459) 555-9246; id 123456789 and 123-45-6789",
    "at 2001:db8::8a2e:370:7334 or fe80::1 or 2001:0DB8:85a3:0000:0000:8a2e:0370:7334, not std::vector a::b 12:30:45",
    "pay DE89370400440532013000 or DE89 3704 0044 0532 0130 00, not DE88370400440532013000; GB29 NWBK 6016 1331 9268 19",
]


def entity_parts(text: str):
    """(kind, text) of all segments, by the same patterns in another engine; a name has several."""
    import regex

    out, at = [], 0
    for m in regex.finditer(pii.ANY, text):
        out.append((None, text[at : m.start()]))
        at, x = m.end(), m[0]
        kind = next(k for k, p in pii.PATTERNS.items() if regex.fullmatch(p, x))
        if kind != "name":
            out.append((kind, x))
        elif after := regex.search(f"({pii._AFTER})$", x):
            out += [("family", x[0]), ("given", x[1 : after.start()]), (None, after[0])]
        else:
            title = regex.match(f"(?:(?:{pii._ADDRESS})\\.? )?", x)[0]
            names = x[len(title) :].split(" ")
            out += [(None, title)] + ([("given", names[0]), (None, " ")] if len(names) == 2 else []) + [("family", names[-1])]
    return [x for x in [*out, (None, text[at:])] if x[1] or x[0]]


def test_surrogates_of_all_texts(spark):
    import regex

    documents = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    people = [f"Mr {a}{b} Smith" for a in "ABCDEFGHIJ" for b in "aeiou bcdfghjklmnpqrs".replace(" ", "")]
    rows = [(i, t) for i, t in enumerate([*PEOPLE, *people, *[t for _, t in documents], None, ""])]
    got = {r.doc_id: r for r in pii.replace(spark.createDataFrame(rows, "doc_id long, text string"), "corpus-release-1").collect()}
    assert len(got) == len(rows) and got[len(rows) - 2].text is None
    digits = lambda x: re.sub("[^0-9]", "", x)
    canon = {"phone": lambda x: digits(x)[-10:], "card": digits, "ssn": digits, "iban": lambda x: x.replace(" ", "")}
    classes = lambda x: regex.sub(r"\p{Ll}", "a", regex.sub(r"\p{Lu}", "A", re.sub("[0-9]", "9", x)))
    script = lambda x: next(s for s in ("Cyrillic", "Greek", "Arabic", "Han", "Latin") if regex.search(rf"\p{{Is{s}}}", x))
    seen, n_entities = {}, 0
    for i, text in rows:
        parts = entity_parts(text or "")
        assert got[i].n_entities == sum(k is not None for k, _ in parts), text
        n_entities += got[i].n_entities
        rest, family = got[i].text or "", None
        for n, (kind, x) in enumerate(parts):
            if kind is None:
                assert rest.startswith(x), (text, got[i].text)
                rest = rest[len(x) :]
                continue
            # what stands in its place: up to the next literal part
            after = next((t for k, t in parts[n + 1 :] if k is None), "")
            if kind == "family" and n + 1 < len(parts) and parts[n + 1][0] == "given":  # no part between them: one sign each at least
                end = 1
            else:
                end = rest.index(after, 1) if after else len(rest)
            y, rest = rest[:end], rest[end:]
            if kind in ("given", "family"):
                assert script(x) == script(y)
            elif kind == "email":
                assert regex.fullmatch(pii.PATTERNS["email"], y)
            elif kind == "ipv6":
                assert re.sub("[0-9A-Fa-f]", "x", x) == re.sub("[0-9A-Fa-f]", "x", y)
            elif kind == "ip":
                assert regex.fullmatch(pii.PATTERNS["ip"], y)
            else:
                assert classes(x) == classes(y), (x, y)
            if kind == "iban":
                valid = lambda v: int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1
                assert valid(canon[kind](x)) == valid(canon[kind](y)) and x[:2] == y[:2]
            if kind not in ("given", "family"):
                f = canon.get(kind, str.lower)
                seen.setdefault(kind, {}).setdefault(f(x), set()).add(f(y))
            elif kind == "given" and "Han" != script(x):
                family = (x, y)
            elif family:
                seen.setdefault("person", {}).setdefault((family[0] + " " + x).lower(), set()).add((family[1] + " " + y).lower())
                family = None
        assert not rest, (text, got[i].text)
    for kind, found in seen.items():
        assert all(len(v) == 1 for v in found.values()), kind  # one entity has one surrogate everywhere
        new = [next(iter(v)) for v in found.values()]
        assert len(set(new)) == len(new) and not set(new) & set(found), kind  # distinct, and none is real
    assert len(seen["person"]) >= 200 and n_entities > 300 and {"email", "phone", "card", "ip", "ipv6", "iban", "ssn"} <= set(seen)
    assert got[5].text.endswith(", not std::vector a::b 12:30:45")


# ---- pipeline ------------------------------------------------------------------------------


def test_pipeline(spark, tmp_path):
    import public_tokenizers as P

    import corpus_pipeline
    from tabspark.llm.bpe import ByteBPE

    rows = quality_rows()
    words = rows[40][1].split()
    rows += [(900, " ".join(words) + " password = abcdefgh " + " ".join(reversed(words)), "en", "a", 1), (901, rows[41][1] + " extra", "en", "a", 1), (902, rows[41][1], "en", "a", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    item = " ".join(rows[60][1].split()[5:20])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    # brute force, stage by stage
    stats = [base_stats(r[1] or "") for r in rows]
    verdicts = mcd([(r[2], r[3], s) for r, s in zip(rows, stats, strict=True)])
    left = [r for r, v in zip(rows, verdicts, strict=True) if v[1]]
    named = {c for _, _, c in brute_components([(r[0], r[1]) for r in left])}
    left = [r for r in left if r[0] in named]
    plain = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", x.translate(LOWER))
    windows = {tuple(plain(item)[j : j + 10]) for j in range(len(plain(item)) - 9)}
    left = [r for r in left if not any(tuple(plain(r[1])[j : j + 10]) in windows for j in range(len(plain(r[1]))))]
    codec = ByteBPE(open(P.path("byte_bpe_multi_50k.tiktoken"), "rb").read(), P.PATTERN)
    want = {}
    for r in left:
        text = r[1]
        for s, _, e in reversed(brute_secrets(text)):
            text = text[:s] + "[SECRET]" + text[e:]
        want[r[0]] = codec.encode(text)
    assert got == want and 900 in got and 902 not in got


def test_backoff_arcs_need_no_search(monkeypatch):
    import numpy as np

    from tabspark.llm.common import squeeze

    texts = [[0, 1, 2, 0, 1], [], [2, 2, 0, 1, 2, 0], [1]] * 20
    lengths, flat = np.array([len(x) for x in texts], "<u4"), np.array([w for x in texts for w in x], "<u4")
    grams = lm.Grams(squeeze(lengths), np.array([11, 22, 33], "<u8").tobytes(), squeeze(flat), 3, 50)
    train = np.repeat(np.arange(len(texts)) % 4 < 2, grams.sizes)  # half of the texts: some n-grams have no arc
    counts = [np.bincount(at[train & (at >= 0)], minlength=len(h)) for h, at in zip(grams.distinct, grams.place, strict=True)]
    automaton = lm.Automaton(grams, counts, 160, 4, len(texts) // 2, (100.0, 10.0))
    monkeypatch.setattr(np, "searchsorted", None)  # reading a text takes or fails arcs by number
    got = automaton.scores(grams.token, grams.starts, grams.sizes)
    c = [{int(g): int(n) for g, n in enumerate(x)} for x in counts]
    want = []
    for start, size in zip(grams.starts.tolist(), grams.sizes.tolist(), strict=True):
        total = 0.0
        for t in range(start, start + size):
            p = (c[0][int(grams.place[0][t])] + 1) / 165
            for n, m in ((2, 100.0), (3, 10.0)):
                if (g := int(grams.place[n - 1][t])) >= 0:
                    context = len(texts) // 2 if t == start else c[n - 2][int(grams.place[n - 2][t - 1])]
                    p = (c[n - 1][g] + m * p) / (context + m)
            total += np.log10(p)
        want.append(total)
    assert np.allclose(got, want, rtol=1e-12)
