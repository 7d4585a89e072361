"""Drift: class mix, confidence, features, rolling monitor."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipward import constants as K
from clipward.functions import columns as C
from clipward.operators import drift, labels, monitor, splits
from clipward.plans import sql_views as Q
from clipward.plans import views as V
from clipward.plans.registry import r6, register, rounded
from clipward.plans.sql_views import query
from clipward.sources import reference_store

_CLASSES = ", ".join(f"('{c}')" for c in V.PRED_CLASSES)

_SHARES = """
names AS (SELECT * FROM (VALUES {classes}) AS t(label)),
e AS (SELECT label, count(*) AS n FROM ref GROUP BY label),
a AS (SELECT label, count(*) AS n FROM live GROUP BY label),
aligned AS (
  SELECT label, coalesce(e.n, 0) / (SELECT sum(n) FROM e) AS expected,
         coalesce(a.n, 0) / (SELECT sum(n) FROM a) AS actual
  FROM names LEFT JOIN e USING (label) LEFT JOIN a USING (label))""".format(classes=_CLASSES)

_PSI = "sum((greatest(actual, 1e-6) - greatest(expected, 1e-6)) * ln(greatest(actual, 1e-6) / greatest(expected, 1e-6)))"

_QUANTILES = f"""
qs AS (SELECT unnest(quantile_cont(confidence, [{", ".join(str(i / 100) for i in range(101))}])) AS r
       FROM ref)"""

# KS of a live sample against the 101 quantiles: at every quantile and just before it.
_POINTS = """
pts AS (SELECT r, (SELECT count(*) FROM qs b WHERE b.r <= a.r) / 101.0 AS f_at,
               (SELECT count(*) FROM qs b WHERE b.r < a.r) / 101.0 AS f_before
        FROM qs a)"""

_KS_QUANTILES = (
    _POINTS
    + """,
ks AS (
  SELECT max(greatest(abs(f_at - le), abs(f_before - lt))) AS ks FROM (
    SELECT r, any_value(f_at) AS f_at, any_value(f_before) AS f_before,
           count(*) FILTER (WHERE confidence <= r) / count(*) AS le,
           count(*) FILTER (WHERE confidence < r) / count(*) AS lt
    FROM pts, live GROUP BY r))"""
)


def prediction_reference(spark: SparkSession, sf_dir: str) -> drift.Reference:
    """Class prior and confidence quantiles of the first ten days."""
    early, _ = V.reference_and_live(V.pred_ok(spark, sf_dir))
    base = drift.reference_from_labels(early, V.PRED_CLASSES, label="label", source="log")
    quantiles = drift.confidence_quantiles(early)
    return drift.extended(base, quantiles=quantiles, n_confidences=int(base.meta["n_rows"]))


@register(
    "a8_class_proportions",
    query(
        Q.PRED,
        """fixed AS (SELECT * FROM (VALUES (0,'click'),(1,'purchase'),(2,'view'),(3,'refund'))
             AS t(position, label)),
        c AS (SELECT label, count(*) AS n FROM pred_ok GROUP BY label)""",
        f"""SELECT position, label, coalesce(n, 0) AS n,
             {Q.r6("coalesce(n, 0) / sum(n) OVER ()")} AS share
        FROM fixed LEFT JOIN c USING (label)""",
    ),
)
def class_proportions(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = labels.class_counts(V.pred_ok(spark, sf_dir), "label")
    return rounded(drift.proportions(counts, ["click", "purchase", "view", "refund"]), "share")


@register(
    "j4_category_alignment",
    query(
        Q.PRED,
        """e AS (SELECT label, count(*) / sum(count(*)) OVER () AS s FROM ref
               WHERE label <> 'view' GROUP BY label),
        a AS (SELECT label, count(*) / sum(count(*)) OVER () AS s FROM live
              WHERE label <> 'click' GROUP BY label)""",
        f"""SELECT label, {Q.r6("coalesce(e.s, 0)")} AS expected, {Q.r6("coalesce(a.s, 0)")} AS actual
        FROM e FULL OUTER JOIN a USING (label)""",
    ),
)
def category_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = V.reference_and_live(V.pred_ok(spark, sf_dir))
    sides = []
    for rows, absent in ((early, "view"), (late, "click")):
        names = [c for c in V.PRED_CLASSES if c != absent]
        sides.append(drift.proportions(labels.class_counts(rows, "label"), names))
    return rounded(drift.align_categories(*sides), "expected", "actual")


@register("f1_population_stability", query(Q.PRED, _SHARES, f"SELECT {Q.r6(_PSI)} AS psi FROM aligned"))
def population_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = V.reference_and_live(V.pred_ok(spark, sf_dir))
    shares = [
        drift.proportions(labels.class_counts(side, "label"), V.PRED_CLASSES)
        for side in (early, late)
    ]
    return rounded(drift.population_stability(drift.align_categories(*shares)), "psi")


@register(
    "w4_key_union",
    query(Q.PRED, "SELECT label FROM ref UNION SELECT label FROM live"),
)
def key_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = V.reference_and_live(V.pred_ok(spark, sf_dir))
    return early.select("label").distinct().union(late.select("label").distinct()).distinct()


@register(
    "f2_ks_two_sample",
    query(
        Q.PRED,
        """v AS (SELECT confidence AS x, 1 AS r, 0 AS l FROM ref UNION ALL
              SELECT confidence, 0, 1 FROM live),
        c AS (SELECT x, sum(r) AS r, sum(l) AS l FROM v GROUP BY x),
        d AS (SELECT sum(r) OVER (ORDER BY x) / sum(r) OVER () AS fr,
                     sum(l) OVER (ORDER BY x) / sum(l) OVER () AS fl FROM c)""",
        f"SELECT {Q.r6('max(abs(fr - fl))')} AS ks FROM d",
    ),
)
def ks_two_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = V.reference_and_live(V.pred_ok(spark, sf_dir))
    return rounded(drift.ks_two_sample(early, late, "confidence"), "ks")


@register(
    "f2_ks_two_sample_by_model",
    query(
        Q.PRED,
        """v AS (SELECT model_name, confidence AS x, 1 AS r, 0 AS l FROM ref UNION ALL
              SELECT model_name, confidence, 0, 1 FROM live),
        c AS (SELECT model_name, x, sum(r) AS r, sum(l) AS l FROM v GROUP BY ALL),
        d AS (SELECT model_name,
                     sum(r) OVER (PARTITION BY model_name ORDER BY x)
                       / sum(r) OVER (PARTITION BY model_name) AS fr,
                     sum(l) OVER (PARTITION BY model_name ORDER BY x)
                       / sum(l) OVER (PARTITION BY model_name) AS fl FROM c)""",
        f"SELECT model_name, {Q.r6('max(abs(fr - fl))')} AS ks FROM d GROUP BY model_name",
    ),
)
def ks_two_sample_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = V.reference_and_live(V.pred_ok(spark, sf_dir))
    return rounded(drift.ks_two_sample(early, late, "confidence", ["model_name"]), "ks")


@register(
    "f3_confidence_ks",
    query(Q.PRED, _QUANTILES, _KS_QUANTILES, f"SELECT {Q.r6('ks')} AS ks, (SELECT count(*) FROM live) AS n_rows FROM ks"),
)
def confidence_ks(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = V.reference_and_live(V.pred_ok(spark, sf_dir))
    samples = drift.confidence_quantiles(early)
    return rounded(drift.ks_to_samples(late, "confidence", samples), "ks")


@register(
    "f4_class_mix_score",
    query(
        Q.PRED, _SHARES, _QUANTILES, _KS_QUANTILES,
        f"""SELECT {Q.r6(_PSI)} AS psi_class, {Q.r6("(SELECT ks FROM ks)")} AS ks_confidence,
             (SELECT count(*) FROM live) AS n_observations, CAST(0 AS BIGINT) AS n_unknown_labels
        FROM aligned""",
    ),
)
def class_mix_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, late = V.reference_and_live(V.pred_ok(spark, sf_dir))
    scored = drift.score_predictions(late, prediction_reference(spark, sf_dir))
    return rounded(scored, "psi_class", "ks_confidence")


@register(
    "f12_drift_severity",
    query(
        Q.PRED,
        f"""e AS (SELECT label, count(*) / sum(count(*)) OVER () AS expected FROM ref GROUP BY label),
        days AS (SELECT strftime(ts, '%Y-%m-%d %H') AS hour, label, count(*) AS n FROM live GROUP BY ALL),
        tot AS (SELECT hour, sum(n) AS t FROM days GROUP BY hour),
        al AS (SELECT hour, label, expected, coalesce(n, 0) / t AS actual
               FROM tot CROSS JOIN e LEFT JOIN days USING (hour, label)),
        p AS (SELECT hour, {_PSI} AS psi FROM al GROUP BY hour)""",
        f"""SELECT hour, {Q.r6("psi")} AS psi,
             CASE WHEN psi >= 0.25 THEN 'alert' WHEN psi >= 0.1 THEN 'warn' ELSE 'ok' END AS severity
        FROM p""",
    ),
)
def drift_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = V.reference_and_live(V.pred_ok(spark, sf_dir))
    reference = drift.reference_from_labels(early, V.PRED_CLASSES, label="label")
    hourly = late.withColumn("hour", F.date_format("ts", "yyyy-MM-dd HH"))
    scored = drift.score_predictions(hourly, reference, ["hour"])
    return scored.select(
        "hour", r6("psi_class").alias("psi"), C.severity(F.col("psi_class")).alias("severity")
    )


_HIST = """
line_bins AS (
  SELECT r.feature, r.position,
         (SELECT count(*) FROM line_edges e WHERE e.feature = r.feature AND e.i BETWEEN 1 AND 9
          AND e.e <= r.x) AS bin
  FROM line_ref r),
line_hist AS (
  SELECT g.feature, g.position, g.i AS bin, e.e AS low, h.e AS high, coalesce(c.n, 0) AS n,
         coalesce(c.n, 0) / sum(coalesce(c.n, 0)) OVER (PARTITION BY g.feature) AS density
  FROM (SELECT feature, position, i FROM line_edges WHERE i < 10) g
  JOIN line_edges e ON e.feature = g.feature AND e.i = g.i
  JOIN line_edges h ON h.feature = g.feature AND h.i = g.i + 1
  LEFT JOIN (SELECT feature, bin, count(*) AS n FROM line_bins GROUP BY ALL) c
    ON c.feature = g.feature AND c.bin = g.i)"""


@register(
    "a10_feature_histograms",
    query(
        Q.LINES, _HIST,
        f"""SELECT position, feature, bin, {Q.r6("low")} AS low, {Q.r6("high")} AS high, n,
             {Q.r6("density")} AS density FROM line_hist""",
    ),
)
def feature_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, _ = V.line_reference_and_live(V.lines(spark, sf_dir))
    table = drift.feature_histograms(early, V.LINE_FEATURES)
    bins = table.select(
        "position", "feature", "edges", "density", F.posexplode("counts").alias("bin", "n")
    )
    edge = lambda shift: F.element_at("edges", F.col("bin") + shift)
    return bins.select(
        "position",
        "feature",
        F.col("bin").cast("long").alias("bin"),
        r6(edge(1)).alias("low"),
        r6(edge(2)).alias("high"),
        "n",
        r6(F.element_at("density", F.col("bin") + 1)).alias("density"),
    )


_LIVE_BINS = """
live_counts AS (
  SELECT r.feature,
         (SELECT count(*) FROM line_edges e WHERE e.feature = r.feature AND e.i BETWEEN 1 AND 9
          AND e.e <= r.x) AS bin, count(*) AS n
  FROM line_live r GROUP BY ALL)"""


@register(
    "a11_fixed_edge_histogram",
    query(Q.LINES, _LIVE_BINS, "SELECT feature, CAST(bin AS INTEGER) AS bin, n FROM live_counts"),
)
def fixed_edge_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = V.line_reference_and_live(V.lines(spark, sf_dir))
    ranges = drift.feature_ranges(early, V.LINE_FEATURES)
    edges = {c: C.equal_width_edges(*ranges[c], K.HISTOGRAM_BINS) for c in ranges}
    return drift.histogram_counts(late, edges)


@register(
    "p10_clip_to_range",
    query(
        Q.LINES,
        """inner_range AS (SELECT feature, lo + (hi - lo) / 4 AS a, hi - (hi - lo) / 4 AS b
                           FROM line_range)""",
        f"""SELECT feature, count(*) AS n, count(*) FILTER (WHERE x < a) AS below,
             count(*) FILTER (WHERE x > b) AS above,
             {Q.r6("avg(least(greatest(x, a), b))")} AS mean_clipped
        FROM line_live JOIN inner_range USING (feature) GROUP BY feature""",
    ),
)
def clip_to_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live values clipped into the middle half of the reference range."""
    early, late = V.line_reference_and_live(V.lines(spark, sf_dir))
    rows = []
    for name, (low, high) in drift.feature_ranges(early, V.LINE_FEATURES).items():
        quarter = (high - low) / 4
        x, a, b = F.col(name), low + quarter, high - quarter
        rows.append(
            F.struct(
                F.lit(name).alias("feature"),
                x.alias("x"),
                (x < a).alias("below"),
                (x > b).alias("above"),
                C.clip_to(x, a, b).alias("clipped"),
            )
        )
    return (
        late.select(F.inline(F.array(*rows)))
        .groupBy("feature")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if("below").alias("below"),
            F.count_if("above").alias("above"),
            r6(F.avg("clipped")).alias("mean_clipped"),
        )
    )


_FEATURE_PSI = f"""
shares AS (
  SELECT h.feature, h.position, h.density AS expected,
         coalesce(c.n, 0) / sum(coalesce(c.n, 0)) OVER (PARTITION BY h.feature) AS actual
  FROM line_hist h LEFT JOIN live_counts c ON c.feature = h.feature AND c.bin = h.bin),
psi AS (SELECT feature, any_value(position) AS position, {_PSI} AS psi FROM shares GROUP BY feature)"""

_FEATURE_KS = """
sizes AS (SELECT feature, count(*) AS n_live FROM line_live GROUP BY feature),
mids AS (
  SELECT h.feature, (low + high) * 0.5 AS mid, n_live,
         greatest(round_even(density * greatest(n_live, 32), 0), 1) AS w
  FROM line_hist h JOIN sizes USING (feature)),
both_sides AS (
  SELECT feature, mid AS x, w AS r, 0 AS l FROM mids
  UNION ALL SELECT feature, x, 0, 1 FROM line_live),
steps AS (SELECT feature, x, sum(r) AS r, sum(l) AS l FROM both_sides GROUP BY feature, x),
cdfs AS (
  SELECT feature,
         sum(r) OVER (PARTITION BY feature ORDER BY x) / sum(r) OVER (PARTITION BY feature) AS fr,
         sum(l) OVER (PARTITION BY feature ORDER BY x) / sum(l) OVER (PARTITION BY feature) AS fl
  FROM steps),
ksf AS (SELECT feature, max(abs(fr - fl)) AS ks FROM cdfs GROUP BY feature)"""


def _scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = V.line_reference_and_live(V.lines(spark, sf_dir))
    table = drift.feature_histograms(early, V.LINE_FEATURES)
    return drift.score_feature_columns(late, drift.collect_histograms(table))


@register(
    "f5_feature_psi",
    query(Q.LINES, _HIST, _LIVE_BINS, _FEATURE_PSI, f"SELECT feature, {Q.r6('psi')} AS psi FROM psi"),
)
def feature_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored_lines(spark, sf_dir).select("feature", r6("psi").alias("psi"))


@register(
    "f6_feature_ks",
    query(
        Q.LINES, _HIST, _FEATURE_KS,
        f"SELECT feature, {Q.r6('ks')} AS ks, n_live FROM ksf JOIN sizes USING (feature)",
    ),
)
def feature_ks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored_lines(spark, sf_dir).select("feature", r6("ks").alias("ks"), "n_live")


@register(
    "f7_feature_drift_summary",
    query(
        Q.LINES, _HIST, _LIVE_BINS, _FEATURE_PSI, _FEATURE_KS,
        f"""SELECT count(*) AS n_features, {Q.r6("avg(psi)")} AS mean_psi, {Q.r6("max(psi)")} AS max_psi,
             (SELECT feature FROM psi ORDER BY psi.psi DESC, position LIMIT 1) AS max_psi_feature,
             {Q.r6("avg(ks)")} AS mean_ks
        FROM psi JOIN ksf USING (feature)""",
    ),
)
def feature_drift_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = drift.feature_drift_summary(_scored_lines(spark, sf_dir))
    return rounded(summary, "mean_psi", "max_psi", "mean_ks")


@register(
    "j6_feature_histogram_join",
    query(
        Q.LINES, _HIST, _LIVE_BINS,
        f"""SELECT feature, h.bin, {Q.r6("density")} AS density, coalesce(c.n, 0) AS n_live
        FROM line_hist h LEFT JOIN live_counts c USING (feature, bin)
        WHERE feature IN ('l_quantity', 'l_tax')""",
    ),
)
def feature_histogram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live counts beside the reference bins of the features that both sides have."""
    early, late = V.line_reference_and_live(V.lines(spark, sf_dir))
    table = drift.feature_histograms(early, V.LINE_FEATURES)
    stored = drift.collect_histograms(table)
    live = late.select("l_quantity", "l_tax")
    shared = {c: stored[c].edges for c in stored if c in live.columns}
    bins = table.select("feature", F.posexplode("density").alias("bin", "density"))
    counts = drift.histogram_counts(live, shared)
    return (
        bins.where(F.col("feature").isin(*shared))
        .join(counts, ["feature", "bin"], "left")
        .select(
            "feature",
            F.col("bin").cast("long").alias("bin"),
            r6("density").alias("density"),
            F.coalesce("n", F.lit(0)).alias("n_live"),
        )
    )


@register(
    "f8_reference_from_labels",
    query(
        Q.FEAT_META,
        """names AS (SELECT 'c' || unnest(range(10)) AS class),
        c AS (SELECT class, count(*) AS n FROM feat_meta WHERE fold = 10 AND NOT is_augmented
              GROUP BY class)""",
        f"""SELECT class, coalesce(n, 0) AS n, {Q.r6("coalesce(n, 0) / sum(n) OVER ()")} AS prior,
             CAST(sum(n) OVER () AS VARCHAR) AS n_rows
        FROM names LEFT JOIN c USING (class)""",
    ),
)
def reference_from_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = splits.fold_originals(V.feat_meta(spark, sf_dir), K.EVAL_FOLD)
    reference = drift.reference_from_labels(rows, [f"c{i}" for i in range(10)])
    row = drift.reference_row(spark, reference)
    return row.select(
        F.explode("class_counts").alias("class", "n"), "class_prior", "meta"
    ).select(
        "class",
        "n",
        r6(F.element_at("class_prior", F.col("class"))).alias("prior"),
        F.element_at("meta", "n_rows").alias("n_rows"),
    )


def _full_reference(spark: SparkSession, sf_dir: str) -> drift.Reference:
    empty = lambda: V.feat(spark, sf_dir).where("fold > 10")
    stored = lambda: V.feat(spark, sf_dir).withColumn(
        "max_proba", F.abs(F.col("f0"))
    )
    return reference_store.build_reference(
        [("processed_tabular", empty), ("interim_metadata", stored)],
        class_names=[f"c{i}" for i in range(10)],
        features=V.FEATURES,
    )


@register(
    "f9_attach_samples",
    query(
        Q.FEAT_LONG,
        """r AS (SELECT * FROM feat_long WHERE fold = 10 AND NOT is_augmented),
        conf AS (SELECT abs(x) AS x FROM r WHERE i = 0)""",
        f"""SELECT CAST((SELECT count(*) FROM conf) AS VARCHAR) AS n_confidence_samples,
             'true' AS has_confidence, 'true' AS has_features, '64' AS n_feature_histograms,
             {Q.r6("(SELECT min(x) FROM conf)")} AS q0,
             {Q.r6("(SELECT quantile_cont(x, 0.5) FROM conf)")} AS q50,
             {Q.r6("(SELECT max(x) FROM conf)")} AS q100,
             {Q.r6("(SELECT min(x) FROM r WHERE i = 63)")} AS f63_low,
             {Q.r6("(SELECT max(x) FROM r WHERE i = 63)")} AS f63_high""",
    ),
)
def attach_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = drift.reference_row(spark, _full_reference(spark, sf_dir))
    meta = lambda name: F.element_at("meta", name).alias(name)
    quantile = lambda i: r6(F.element_at("confidence_quantiles", i + 1)).alias(f"q{i}")
    edges = F.element_at("feature_histograms", F.lit("f63"))["edges"]
    return row.select(
        meta("n_confidence_samples"),
        meta("has_confidence"),
        meta("has_features"),
        meta("n_feature_histograms"),
        quantile(0),
        quantile(50),
        quantile(100),
        r6(F.element_at(edges, 1)).alias("f63_low"),
        r6(F.element_at(edges, -1)).alias("f63_high"),
    )


@register(
    "f10_build_reference",
    query(
        Q.FEAT_LONG,
        """r AS (SELECT * FROM feat_long WHERE fold = 10 AND NOT is_augmented),
        g AS (SELECT i, min(x) AS lo, max(x) AS hi FROM r GROUP BY i),
        e AS (SELECT i, b, lo + b * ((hi - lo) / 10) AS e FROM g, (SELECT unnest(range(1, 10)) AS b)),
        placed AS (SELECT r.i, (SELECT count(*) FROM e WHERE e.i = r.i AND e.e <= r.x) AS bin FROM r),
        c AS (SELECT i, bin, count(*) AS n FROM placed GROUP BY ALL)""",
        f"""SELECT 'f' || i AS feature, b AS bin,
             {Q.r6("coalesce(n, 0) / (SELECT count(*) FROM r WHERE i = 0)")} AS density,
             'interim_metadata' AS source
        FROM g CROSS JOIN (SELECT unnest(range(10)) AS b) LEFT JOIN c USING (i)
        WHERE c.bin = b
        UNION ALL
        SELECT 'f' || i, b, 0.0, 'interim_metadata'
        FROM g CROSS JOIN (SELECT unnest(range(10)) AS b)
        WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.i = g.i AND c.bin = b)""",
    ),
)
def build_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = drift.reference_row(spark, _full_reference(spark, sf_dir))
    return (
        row.select(F.explode("feature_histograms").alias("feature", "h"), "meta")
        .select(
            "feature",
            F.posexplode("h.density").alias("bin", "density"),
            F.element_at("meta", "source").alias("source"),
        )
        .select("feature", F.col("bin").cast("long").alias("bin"), r6("density").alias("density"), "source")
    )


# Trailing frame of N predictions per model, with its class shares and confidence KS.
_ROLLING = f"""
names AS (SELECT * FROM (VALUES {_CLASSES}) AS t(label)),
e AS (SELECT label, count(*) / sum(count(*)) OVER () AS expected FROM ref GROUP BY label),
nums AS (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY ts, event_id) AS rn FROM pred_ok),
shares AS (
  SELECT event_id, model_name, rn, names.label, expected,
         sum(CASE WHEN nums.label = names.label THEN 1 ELSE 0 END) OVER (
           PARTITION BY model_name, names.label ORDER BY rn ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)
           / 100.0 AS actual
  FROM nums CROSS JOIN names JOIN e ON e.label = names.label),
psi AS (SELECT event_id, model_name, rn, {_PSI} AS psi FROM shares WHERE rn >= 100 GROUP BY ALL)"""

_ROLLING_KS = """
gaps AS (
  SELECT event_id, rn, r, f_at, f_before,
         sum(CASE WHEN confidence <= r THEN 1 ELSE 0 END) OVER w / 100.0 AS le,
         sum(CASE WHEN confidence < r THEN 1 ELSE 0 END) OVER w / 100.0 AS lt
  FROM nums CROSS JOIN (SELECT DISTINCT * FROM pts)
  WINDOW w AS (PARTITION BY model_name, r ORDER BY rn ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)),
rks AS (SELECT event_id, max(greatest(abs(f_at - le), abs(f_before - lt))) AS ks FROM gaps
        WHERE rn >= 100 GROUP BY event_id)"""


@register(
    "f11_rolling_monitor",
    query(
        Q.PRED, _QUANTILES, _POINTS, _ROLLING, _ROLLING_KS,
        f"""SELECT model_name, event_id, {Q.r6("psi")} AS psi_class, {Q.r6("ks")} AS ks_confidence,
             CAST(100 AS BIGINT) AS n_observations
        FROM psi JOIN rks USING (event_id)""",
    ),
)
def rolling_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference = prediction_reference(spark, sf_dir)
    log = V.pred_ok(spark, sf_dir).select("model_name", "ts", "event_id", "label", "confidence")
    out = monitor.rolling_monitor(log, reference, key="model_name", order=["ts", "event_id"])
    return rounded(out.drop("ts"), "psi_class", "ks_confidence")


@register(
    "w1_count_bounded_frame",
    query(
        Q.PRED,
        f"""SELECT model_name, event_id,
             count(*) OVER w AS filled, {Q.r6("avg(confidence) OVER w")} AS mean_confidence,
             CAST(sum(CASE WHEN label = 'view' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS n_view
        FROM pred_ok WINDOW w AS (PARTITION BY model_name ORDER BY ts, event_id
                                  ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)""",
    ),
)
def count_bounded_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = V.pred_ok(spark, sf_dir).select("model_name", "ts", "event_id", "label", "confidence")
    frames = monitor.trailing_frame(
        log,
        key="model_name",
        order=["ts", "event_id"],
        rows=K.MONITOR_WINDOW,
        aggregates={
            "filled": lambda w: F.count(F.lit(1)).over(w),
            "mean_confidence": lambda w: F.avg("confidence").over(w),
            "n_view": lambda w: F.sum(F.when(F.col("label") == "view", 1).otherwise(0)).over(w),
        },
    )
    return rounded(
        frames.select("model_name", "event_id", "filled", "mean_confidence", "n_view"),
        "mean_confidence",
    )
