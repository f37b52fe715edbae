"""Secret scans over an incremental blob ledger, in DataFrame functions only.

A blob is a text's content address (SHA-256). The ledger is a table of the (blob, rule
version) pairs scanned so far with their findings. A scan takes one text for each blob that
the ledger lacks at this rule version, scans those alone, and joins findings back to every
row (path, version) with that content. Which rows are scanned is settled on keys alone; the
texts then meet the shorter of two key lists, of the rows to scan or of the rows to leave
out. So where nearly all or next to nothing is new, that list is small and no text moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, near

#: Kind, pattern (Java), least characters, group that they count in. In the
#: order in which kinds are listed; the first three are the base.
RULES = (
    ("assign", "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 2),
    ("access", "AKIA[A-Z0-9]+", 20, 0),
    ("hex", "[0-9a-f]+", 24, 0),
    ("github", "gh[pousr]_[A-Za-z0-9]+", 40, 0),
    ("jwt", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", 40, 0),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\\s]*-----END [A-Z ]*PRIVATE KEY-----", 0, 0),
)
BASE = 3
#: Changes whenever RULES do: blobs are then scanned again.
RULE_VERSION = "1"
SPAN = "struct<start:int,kind:int,stop:int>"
#: What a text must have for a rule to apply; only the rules' cost depends on it.
NEEDS = ("[:=]", "AKIA", "[0-9a-f]{24}", "gh[pousr]_", "eyJ", "PRIVATE KEY")


def _spans(text: Column, number: int) -> Column:
    """Spans of one rule: leftmost non-overlapping matches, then those that are too short dropped.

    Only matched strings can be had from an expression; a match's place is the length of
    what a split by the same pattern leaves before it, plus the matches before it.
    """
    kind, pattern, least, group = RULES[number]
    # a run shorter than ``least`` fails anyway and what matches within it, being shorter, fails
    # too: the bound can stand in the pattern where the match is one run of its last class
    if kind in ("access", "hex"):
        head, run = pattern[: pattern.rindex("[")], pattern[pattern.rindex("[") : -1]
        fixed = {"access": 4, "hex": 0}[kind]
        pattern, least = f"{head}{run}{{{least - fixed},}}", 0
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    sizes = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if least else found
    steps = F.zip_with(F.slice(gaps, 1, F.size(found)), F.arrays_zip(found.alias("m"), sizes.alias("g")), lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m["m"]).alias("n"), F.length(m["g"]).alias("g")))
    empty = F.array().cast(f"array<{SPAN}>")
    walked = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda a, s: F.struct(
            (a["at"] + s["gap"] + s["n"]).alias("at"),
            F.when(
                s["g"] >= least,
                F.concat(a["out"], F.array(F.struct((a["at"] + s["gap"]).alias("start"), F.lit(number).alias("kind"), (a["at"] + s["gap"] + s["n"]).alias("stop")))),
            )
            .otherwise(a["out"])
            .alias("out"),
        ),
        lambda a: a["out"],
    )
    return F.when(text.rlike(NEEDS[number]), walked).otherwise(empty)


def find(frame: DataFrame, text_col: str) -> DataFrame:
    """``frame`` with ``spans array<struct<start,kind,stop>>`` by start, then kind as listed; code points, stop exclusive."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return frame.withColumn("spans", F.sort_array(F.concat(*[_spans(text, i) for i in range(len(RULES))])))


def scan(docs: DataFrame, ledger: DataFrame | None = None, *, id_col: str = "doc_id", text_col: str = "text", version: str = RULE_VERSION) -> tuple[DataFrame, DataFrame]:
    """``(findings, new entries)``: spans for every row of ``docs``, and what to append to the ledger.

    findings: ``id_col, blob, spans``; entries: ``blob, version, spans``. ``ledger`` has the
    entries of earlier scans. Null text is the empty blob; null ids and repeated rows each
    keep their row; other columns are ignored; empty tables give empty results.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    given = docs.select(F.col(f"`{id_col}`").alias("_id"), text.alias("_t"), F.sha2(text, 256).alias("blob"))
    keys = materialize(given.select("_id", "blob"), "blob-keys")
    seen = None if ledger is None else ledger.where(F.col("version") == version)
    unseen = keys if seen is None else keys.join(seen.select("blob").distinct(), "blob", "left_anti")
    # the least id stands for a blob: one row for each after map-side aggregation
    chosen = materialize(unseen.groupBy(F.col("blob").alias("_b")).agg(F.min("_id").alias("_i")), "blob-chosen")
    scanned = find(_texts(given, keys, chosen), "_t")
    # copies with one id give one entry
    entries = materialize(scanned.select("blob", F.lit(version).alias("version"), "spans").dropDuplicates(["blob"]), "blob-ledger")
    known = entries if seen is None else entries.unionByName(seen.select("blob", "version", "spans"))
    hits = materialize(known.where(F.size("spans") > 0).select("blob", "spans"), "blob-hits")
    out = keys.join(hits, "blob", "left").select(F.col("_id").alias(id_col), "blob", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))
    return out, entries


def _texts(given: DataFrame, keys: DataFrame, chosen: DataFrame) -> DataFrame:
    """One text for each chosen blob (more only where rows repeat with their id)."""
    same = (F.col("blob") == F.col("_b")) & F.col("_id").eqNullSafe(F.col("_i"))
    others = keys.distinct().join(chosen, same, "left_anti").select(F.col("blob").alias("_b"), F.col("_id").alias("_i"))
    others = materialize(others, "blob-others")
    if others.count() < chosen.count():
        return given.join(near(others), same, "left_anti").select("blob", "_t")
    return given.join(near(chosen), same, "left_semi").select("blob", "_t")


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(r[0]) for r in RULES])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The query contract's columns, from :func:`scan` with an empty ledger."""
    findings, _ = scan(docs, id_col=id_col, text_col=text_col)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return findings.select(
        id_col,
        *[count(k).alias(f"n_{RULES[k][0]}") for k in range(BASE)],
        F.sha2(_listed(F.filter("spans", lambda s: s["kind"] < BASE)), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, ledger: DataFrame | None = None, *, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span that :func:`scan` finds replaced by ``mark`` (overlapping spans by one).

    Rows, order of columns and all other columns stay; a null text stays null. ``n_chars``,
    where there is such a column, is set to the new text's length if the text changed.
    """
    findings, _ = scan(docs, ledger, id_col=id_col, text_col=text_col)
    # as small as the findings: where they are few, the texts stay where they are
    hits = materialize(findings.where(F.size("spans") > 0).select(F.col("blob").alias("_b"), F.col("spans").alias("_spans")).dropDuplicates(["_b"]), "redact-hits")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    text = F.col(f"`{text_col}`").cast("string")
    given = docs.select(row, text.alias("_t"), F.sha2(F.coalesce(text, F.lit("")), 256).alias("_blob"))
    found = given.join(near(hits), F.col("_blob") == F.col("_b"), "left")
    pieces = F.aggregate(
        "_spans",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.when(s["stop"] <= a["at"], a).otherwise(
            F.struct(
                s["stop"].alias("at"),
                F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(a["out"], F.substring("_t", a["at"] + 1, s["start"] - a["at"]), F.lit(mark))).alias("out"),
            )
        ),
        lambda a: F.concat(a["out"], F.substring("_t", a["at"] + 1, F.length("_t"))),
    )
    changed = F.col("_spans").isNotNull()
    found = found.withColumn("_new", F.when(changed, pieces).otherwise(F.col("_t")))
    columns = []
    for c in docs.columns:
        if c == text_col:
            columns.append(F.col("_new").alias(c))
        elif c == "n_chars":
            columns.append(F.when(changed, F.length("_new").cast(docs.schema[c].dataType)).otherwise(F.col("_row")[c]).alias(c))
        else:
            columns.append(F.col("_row")[c].alias(c))
    return found.select(*columns)
