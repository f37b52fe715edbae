"""Whole runs: evaluate two tables against each other, generate a set of related tables, report."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sources as S
from ..functions import null_pattern
from ..operators import compare as C
from ..operators import generate as G
from ..operators import membership as M
from ..operators import privacy as Y
from ..operators import profile as P
from ..operators import relational as R
from ..operators import scoring as K
from ..operators import text as X
from ..operators import vectors as W


@dataclass
class TableSpec:
    """What an evaluation needs to know of a table."""

    name: str
    key: list[str]
    categorical: list[str] = field(default_factory=list)
    numeric: list[str] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    temporal: list[str] = field(default_factory=list)
    identity: list[str] = field(default_factory=list)


def _melt(df: DataFrame, unit, values: dict[str, str], floor: str | None = None) -> DataFrame:
    """metric_id, unit, value rows from one column for each metric; and the floor of noise, where it was measured."""
    parts = F.array(*[F.struct(F.lit(m).alias("metric_id"), F.col(c).cast("double").alias("value")) for m, c in values.items()])
    noise = (F.col(floor) if floor else F.lit(None)).cast("double").alias("floor")
    return df.select(unit.alias("unit"), noise, F.explode(parts).alias("x")).select("x.metric_id", "unit", "x.value", "floor")


#: Rows of R and of H, of privacy panels and of the classes that are told apart; all rows where there are fewer.
PANEL, EXPOSED = 2000, 500


def metrics(source: DataFrame, synthetic: DataFrame, spec: TableSpec, edges: int = 20, models: bool = False) -> DataFrame:
    """metric_id, table_name, unit, value, noise of one table.

    The sides are read once for each family of metrics, whatever the number of columns: the
    census of all discrete columns, the bins of all numeric ones, all moments, all rates.
    ``models`` adds the metrics of trained classifiers. Noise is that of the sides' sizes.
    """
    both = C.sided(source, synthetic)
    parts: list[DataFrame] = []
    discrete, column = spec.categorical + spec.text, F.col("column")
    rest = [c for c in discrete + spec.numeric + spec.temporal if c not in spec.key]
    if discrete:
        census = C.census(both, discrete)
        floors = C.chance_floors(census, "column").select("column", F.col("tvd_floor").alias("floor"))
        distances = C.frequency_distances(census, "column").join(F.broadcast(floors), "column")
        parts.append(_melt(distances, column, {"column.tvd": "tvd", "column.jsd": "jsd", "column.cohens_w": "cohens_w"}, "floor"))
        parts.append(_melt(C.diversity(census, "column"), column, {"column.coverage_mass": "coverage", "column.novelty_mass": "novelty", "field.category_adherence": "adherence", "column.top1_share_delta": "top1_delta"}))
        row = F.to_json(F.struct(*[F.col(c) for c in spec.key]))
        parts.append(_melt(C.ratios(C.census(Y.matched(both, row, "matched"), discrete), "column"), column, {"column.entropy_ratio": "entropy_ratio", "column.distinct_ratio": "distinct_ratio"}))
        parts.append(_melt(C.ceiling_hit(census, [512], "column"), column, {"column.distinct_ceiling_hit": "hit"}))
        copies = C.substantive_copies(both, discrete, 10).withColumn("rate", F.col("copies") / F.col("n"))
        parts.append(_melt(copies, column, {"field.substantive_copy_rate": "rate"}))
        for i, a in enumerate(spec.categorical):
            for b in spec.categorical[i + 1 :]:
                unit = F.lit(f"{a}~{b}")
                parts.append(_melt(C.side_deltas(both, lambda d, a=a, b=b: C.contingency(d, a, b), {"cramers_v": "v", "nmi": "nmi"}), unit, {"pair.cramers_v_delta": "v", "pair.nmi_delta": "nmi"}))
                parts.append(_melt(C.joint_tvd(both, a, b), unit, {"pair.contingency_tvd": "contingency_tvd"}))
    if spec.numeric:
        parts.append(_melt(C.moment_deltas(both, spec.numeric), column, {"column.smd": "smd", "column.std_ratio": "std_ratio", "column.range_coverage": "range_coverage", "field.range_adherence": "range_adherence"}))
        # a planning scan of each column gives its interior edges: a few numbers
        grid = {c: sorted({r.value for r in P.quantiles(source, c, [i / edges for i in range(1, edges)]).collect() if r.value is not None}) or [0.0] for c in spec.numeric}
        parts.append(_melt(C.binned_distances_by(C.binned_columns(both, grid), grid), column, {"column.ks": "ks", "column.pit_w1": "pit_w1", "column.psi": "psi", "column.wasserstein": "w1"}))
        parts.append(_melt(C.type_validity(synthetic, spec.numeric), column, {"field.type_validity": "validity"}))
        pairs = [(a, b) for i, a in enumerate(spec.numeric) for b in spec.numeric[i + 1 :]]
        if pairs:
            deltas = C.pearson(both, pairs)
            parts.append(_melt(deltas, F.concat_ws("~", "a", "b"), {"pair.pearson_delta": "pearson_delta"}))
            parts.append(_melt(C.correlation_summary(deltas), F.lit("*"), {"table.corr_rms_delta": "corr_rms_delta", "table.corr_max_delta": "corr_max_delta"}))
        for a, b in pairs:
            of = lambda s: F.max(F.when(F.col("side") == s, F.col("spearman")))
            parts.append(_melt(C.spearman(both, a, b).agg(F.abs(of(1) - of(0)).alias("d")), F.lit(f"{a}~{b}"), {"pair.spearman_delta": "d"}))
    for c in spec.text:
        parts.append(_melt(C.char_classes(both, c), F.lit(c), {"column.char_class_l1": "char_class_l1"}))
        parts.append(_melt(C.shape_head_tv(both, c, 0.02), F.lit(c), {"column.shape_head_tv": "shape_head_tv"}))
        parts.append(_melt(X.shape_adherence(both, c), F.lit(c), {"field.shape_adherence": "adherence"}))
        lengths = [float(i) for i in range(1, 65)]
        parts.append(_melt(C.binned_distances(C.binned(both, F.length(c).cast("double"), lengths), lengths), F.lit(c), {"column.length_ks": "ks"}))
    for c in spec.temporal:
        days = [P.calendar(d, c).select("part", "slot", *[(F.col("n") if side == i else F.lit(0)).cast("long").alias(x) for i, x in enumerate(("c_src", "c_syn"))]) for side, d in enumerate((source, synthetic))]
        counted = days[0].union(days[1]).groupBy("part", "slot").agg(F.sum("c_src").alias("c_src"), F.sum("c_syn").alias("c_syn"))
        tvd = C.frequency_distances(counted, "part").join(F.broadcast(C.chance_floors(counted, "part").select("part", F.col("tvd_floor").alias("floor"))), "part")
        for p in ("dow", "month", "hour"):
            parts.append(_melt(tvd.where(F.col("part") == p), F.lit(c), {f"column.{p}_tvd": "tvd"}, "floor"))
    parts.append(_melt(C.rates_of(both, discrete + spec.numeric), column, {"column.null_rate_delta": "null_rate_delta", "column.empty_rate_delta": "empty_rate_delta", "column.zero_rate_delta": "zero_rate_delta"}))
    parts.append(_melt(M.exact_matches(synthetic, source, spec.key + rest), F.lit("*"), {"row.exact_match_rate": "rate"}))
    if rest:
        parts.append(_melt(M.exact_matches(synthetic, source, rest), F.lit("*"), {"row.exact_match_rate_nonkey": "rate"}))
        patterns = both.groupBy(null_pattern(*[F.col(c) for c in rest]).alias("value")).agg(F.count_if(F.col("side") == 0).alias("c_src"), F.count_if(F.col("side") == 1).alias("c_syn")).withColumn("g", F.lit(1))
        parts.append(_melt(C.frequency_distances(patterns, "g"), F.lit("*"), {"row.null_pattern_tvd": "tvd"}))
        panel = S.panel(source, F.to_json(F.struct(*[F.col(c) for c in spec.key])), PANEL, EXPOSED)
        parts.append(_melt(M.lifts(synthetic, panel, rest), F.lit("*"), {"row.memorization_lift": "lift"}))
        parts.append(_melt(M.exposure_lift(synthetic, panel, rest), F.lit("*"), {"row.exposure_lift": "lift"}))
        for c in discrete:
            parts.append(_melt(M.value_lift(synthetic, panel, c, 10), F.lit(c), {"field.value_memorization_lift": "lift"}))
        m = min(source.count(), synthetic.count())
        twice = lambda d: Y.rarefied_duplicates(M.frequency_of_frequencies(d, rest), m).select("duplicate_share")
        excess = twice(synthetic).crossJoin(F.broadcast(twice(source).withColumnRenamed("duplicate_share", "s"))).select(F.greatest(F.lit(0.0), F.col("duplicate_share") - F.col("s")).alias("x"))
        parts.append(_melt(excess, F.lit("*"), {"row.internal_duplicate_excess": "x"}))
    if len(rest) > 1:
        near = M.near_matches(synthetic, source, rest).withColumn("rate", F.col("near") / F.col("n"))
        parts.append(_melt(near, F.lit("*"), {"row.near_match_rate": "rate"}))
        parts.append(_melt(M.near_match_lift(synthetic.select(*rest), panel.select("side", *rest), rest), F.lit("*"), {"row.near_match_lift": "lift"}))
    if spec.numeric:
        parts += _privacy(source, synthetic, panel, spec)
    if models and spec.numeric:
        some = C.sided(*[S.reference_sample(d, F.col(spec.key[0]), PANEL) for d in (source, synthetic)])
        parts.append(_melt(W.auc(Y.out_of_fold_scores(some, spec.numeric, spec.key[0]), "score", "side"), F.lit("*"), {"table.detection_auc": "auc"}))
        parts.append(_melt(Y.pmse_ratio(Y.out_of_fold_scores(some, spec.numeric, spec.key[0], folds=2, boosted=False), len(spec.numeric)), F.lit("*"), {"table.pmse_ratio": "pmse_ratio"}))
    parts.append(_melt(M.duplicate_rate(synthetic, spec.key), F.lit("*"), {"table.pk_duplicate_rate": "rate"}))
    for c in spec.identity:
        parts.append(_melt(M.duplicate_rate(synthetic, [c]), F.lit(c), {"table.identity_duplicate_rate": "rate"}))
    sizes = both.agg(F.count_if(F.col("side") == 0).cast("double").alias("n"), F.count_if(F.col("side") == 1).cast("double").alias("m"))
    parts.append(_melt(sizes.select((F.col("m") / F.col("n")).alias("x")), F.lit("*"), {"table.row_count_ratio": "x"}))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    sized = K.noise_floors(out.crossJoin(F.broadcast(sizes)))
    return sized.select("metric_id", F.lit(spec.name).alias("table_name"), "unit", "value", F.coalesce("noise", F.lit(0.0)).alias("noise"))


def _privacy(source: DataFrame, synthetic: DataFrame, panel: DataFrame, spec: TableSpec) -> list[DataFrame]:
    """Distances of a sample of the synthetic rows, and of H, to R; balls around rows of R."""
    key = spec.key[0]
    ends = source.agg(*[F.min(c).cast("double").alias(f"a_{c}") for c in spec.numeric], *[F.max(c).cast("double").alias(f"b_{c}") for c in spec.numeric]).first()
    span = {c: max((ends[f"b_{c}"] or 0.0) - (ends[f"a_{c}"] or 0.0), 1e-12) for c in spec.numeric}
    asked = S.reference_sample(synthetic, F.col(key), PANEL)
    r, h = panel.where("side = 'R'"), panel.where("side = 'H'")
    nearest = lambda q, ref: W.gower_nearest(q, ref, span, spec.categorical, key)
    to_r = nearest(asked, r)
    share = W.nearest_summary(to_r, nearest(asked, h))
    scaled = lambda d: d.select(key, *[(F.col(c).cast("double") / span[c]).alias(c) for c in spec.numeric])
    balls = Y.density_coverage(scaled(r), scaled(asked), spec.numeric, 5, id_col=key)
    ratios = W.nearest_percentiles(to_r, nearest(h, r))
    return [_melt(share, F.lit("*"), {"row.dcr_train_holdout_share": "dcr_share"}), _melt(balls, F.lit("*"), {"row.density": "density", "row.coverage": "coverage"}), _melt(ratios, F.lit("*"), {"row.dcr_p5_ratio": "dcr_p5_ratio", "row.nndr_p5_ratio": "nndr_p5_ratio"})]


def edge_metrics(source: tuple[DataFrame, DataFrame], synthetic: tuple[DataFrame, DataFrame], fk: str, pk: str, name: str, edge: str) -> DataFrame:
    """The same rows for one declared edge; each side is (child, parent)."""
    counts = [R.fanout(c, p, fk, pk).select("k") for c, p in (source, synthetic)]
    w1 = _melt(R.fanout_w1(*counts), F.lit(edge), {"relationship.fanout_w1": "fanout_w1"})
    own = _melt(R.orphan_rate(*source, fk, pk), F.lit(edge), {"relationship.orphan_rate_source": "orphan_rate"})
    a = _melt(R.fanout_metrics(*counts), F.lit(edge), {f"relationship.{m}": m for m in ("fanout_tvd", "fanout_mean_ratio", "zero_child_share_delta", "parent_coverage", "cardinality_adherence")})
    b = _melt(R.orphan_rate(*synthetic, fk, pk), F.lit(edge), {"relationship.orphan_rate": "orphan_rate"})
    return a.unionByName(b).unionByName(w1).unionByName(own).select("metric_id", F.lit(name).alias("table_name"), "unit", "value", F.lit(0.0).alias("noise"))


def evaluate(source: DataFrame, synthetic: DataFrame, spec: TableSpec, models: bool = False) -> DataFrame:
    """Scored metric rows."""
    return K.scored(metrics(source, synthetic, spec, models=models))


def generate_table(spark: SparkSession, source: DataFrame, spec: TableSpec, rows: int, salt: str) -> DataFrame:
    """``rows`` rows with the source's marginals, every cell a function of the row number and the salt."""
    ids = spark.range(rows).withColumnRenamed("id", "_row")
    return _columns(ids, source, spec, salt).drop("_row")


def _columns(ids: DataFrame, source: DataFrame, spec: TableSpec, salt: str) -> DataFrame:
    """``ids`` (with ``_row``) and the columns of a table that ``ids`` lacks."""
    out = ids
    todo = lambda cs: [c for c in cs if c not in ids.columns]
    for c in todo(spec.key + spec.identity):
        out = G.identity(out, c, "_row", f"{salt}|{c}")
    for c in todo(spec.categorical + spec.text):
        out = G.categorical(out, source, c, "_row", f"{salt}|{c}")
    for c in todo(spec.numeric):
        out = G.numeric(out, G.quantile_grid(source, c, 101), c, "_row", f"{salt}|{c}")
    for c in todo(spec.temporal):
        micros = source.select(F.unix_micros(F.col(c).cast("timestamp")).alias("us"))
        out = G.temporal(out, G.quantile_grid(micros, "us", 101), c, "_row", f"{salt}|{c}").withColumn(c, F.timestamp_micros(c))
    return out


def generate_model(sources: dict[str, DataFrame], model: R.Model, specs: dict[str, TableSpec], salt: str, roots: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """Whole rows of all tables, parents first.

    A root has as many rows as its source (or as ``roots`` says). The rows of a child come
    from its driving edge: each parent gets children by the measured fan-out. Its other
    enforced edges, composite keys whole, are drawn from the parents made here. All other
    columns follow the source's marginals.
    """
    out: dict[str, DataFrame] = {}
    for wave in model.waves():
        for t in wave:
            edge, spark = model.driving(t), sources[t].sparkSession
            if edge is None:
                rows = (roots or {}).get(t) or sources[t].count()
                ids = spark.range(rows).withColumnRenamed("id", "_row")
            else:
                hist = R.fanout_histogram(sources[t], sources[edge.parent], *edge.columns[0])
                pairs = list(edge.columns)
                parents = out[edge.parent].select(*[F.col(p).alias(f) for f, p in pairs])
                ids = G.children(parents, pairs[0][0], hist, f"{salt}|{t}")
                if len(pairs) > 1:
                    ids = ids.join(parents, pairs[0][0])
                ids = ids.withColumn("_row", F.concat_ws("|", F.col(pairs[0][0]).cast("string"), F.col("ordinal").cast("string"))).drop("ordinal")
            for e in (e for e in model.edges if e.child == t and e.enforced and e is not edge):
                ids = _drawn_keys(ids, out[e.parent], e, f"{salt}|{t}|{e.parent}")
            out[t] = _columns(ids, sources[t], specs[t], f"{salt}|{t}").drop("_row")
    return out


def _drawn_keys(ids: DataFrame, parent: DataFrame, edge: R.Edge, salt: str) -> DataFrame:
    """``ids`` with the columns of one more parent, its key tuples drawn whole with equal chances."""
    names = {p: f for f, p in edge.columns}
    tuples = parent.select(*[F.col(p).alias(f"_{names[p]}") for p in names]).na.drop().distinct().withColumn("weight", F.lit(1))
    keys = [f"_{f}" for f in names.values()]
    drawn = G.joint_keys(ids.drop(*names.values()), tuples, keys, "_row", salt)
    return drawn.withColumnsRenamed({k: k[1:] for k in keys})


def report(scored: DataFrame) -> str:
    """Markdown of the headline, the failing metrics and the roll-up (result rows: as many as metrics)."""
    lines = ["# Evaluation", ""]
    lines += [f"- {r.status}: {r.n}" for r in K.headline(scored).orderBy("status").collect()]
    lines += ["", "| metric | table | unit | value | status |", "| --- | --- | --- | --- | --- |"]
    lines += [f"| {r.metric_id} | {r.table_name} | {r.unit} | {r.value:.6g} | {r.status} |" for r in scored.where("status IN ('FAIL', 'WARN')").orderBy("metric_id", "table_name", "unit").collect()]
    lines += ["", "| level | table | family | score |", "| --- | --- | --- | --- |"]
    lines += [f"| {r.level} | {r.table_name or ''} | {r.family or ''} | {r.score} |" for r in K.rollup(scored).orderBy("level", "table_name", "family").collect()]
    return "\n".join(lines)


def report_json(scored: DataFrame) -> str:
    """The same as one JSON object: counts by status, the rows that fail or warn, the roll-up."""
    import json

    rows = lambda d, *by: [r.asDict() for r in d.orderBy(*by).collect()]
    bad = scored.where("status IN ('FAIL', 'WARN')").select("metric_id", "table_name", "unit", "value", "status")
    return json.dumps({"status": {r["status"]: r["n"] for r in rows(K.headline(scored), "status")}, "failing": rows(bad, "metric_id", "table_name", "unit"), "scores": rows(K.rollup(scored), "level", "table_name", "family")}, sort_keys=True)


def render_catalogue() -> str:
    """The metric catalogue as a Markdown table."""
    lines = ["| metric | family | direction | target | warn | fail |", "| --- | --- | --- | --- | --- | --- |"]
    return "\n".join(lines + ["| " + " | ".join("" if x is None else str(x) for x in row) + " |" for row in K.CATALOGUE])


def profile(df: DataFrame, spec: TableSpec) -> dict[str, DataFrame]:
    """The profile frames of one table by name."""
    columns = spec.key + spec.categorical + spec.numeric + spec.text + spec.temporal
    out = {"counts": P.counts(df, columns), "kinds": P.kinds(df, columns)}
    if spec.numeric:
        out["numeric"] = P.numeric(df, spec.numeric)
    if spec.categorical:
        out |= {"mix": P.value_mix(df, spec.categorical), "top": P.top_values(df, spec.categorical, 10)}
    out |= {f"calendar:{c}": P.calendar(df, c) for c in spec.temporal} | {f"lengths:{c}": P.lengths(df, c) for c in spec.text}
    return out
