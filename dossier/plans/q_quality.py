"""Labelled-set, metric, split, k-NN and model query bindings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.operators import ml as M
from dossier.operators import parse as P
from dossier.operators import quality as Q
from dossier.operators import ranking as RK
from dossier.operators.knn import knn_pivots
from dossier.plans import oracle as O
from dossier.plans import views as V
from dossier.plans.catalog import register
from dossier.plans.q_parse import REPLIES_SQL
from dossier.session import materialize
from dossier.sources.tables import spread

SINCE_YEAR = 1998
FOLDS, FOLD_SEED = 5, 0
TEST_FRACTION, SPLIT_SEED = 0.15, 0
KNN_K = 7
VALIDATION_ROW = 745
CATEGORY_COLS = ("name", "state", "college_major", "undergraduate_institution", "highest_degree",
                 "work_history", "sources", "party")
LABELLED_COLS = ("candid", "row", "name", "state", "min_year", *P.FOUR_FIELDS, "sources", "party",
                 "accuracy")


def _rule(n_chars="n_chars", toxic="toxic"):
    """A fixed stand-in prediction to evaluate: long, non-toxic -> correct."""
    return F.when((F.col(n_chars) >= 1000) & (F.col(toxic) == 0), 1).otherwise(0)


RULE_SQL = "CASE WHEN n_chars >= 1000 AND toxic = 0 THEN 1 ELSE 0 END"


def labelled(spark, sf_dir):
    """Labelled replies, parsed (N/A answers as null); labels are joined
    first, so that only labelled replies are parsed."""
    replies, lab = V.replies(spark, sf_dir), V.table(spark, sf_dir, "labels")
    j = replies.join(lab, replies["row"] == lab["doc_id"])
    return P.null_answer_tokens(P.parse_replies(j, "response")).select("candid", "row", "name", "state", "min_year", *P.FOUR_FIELDS, "sources",
                    F.col("lang").alias("party"), "source", "n_chars", "toxic",
                    F.col("quality").alias("accuracy"))


LABELLED_SQL = REPLIES_SQL + f""",
nulled AS (
  SELECT *, {O.null_tokens('college_major')} AS cm, {O.null_tokens('undergraduate_institution')} AS ui,
         {O.null_tokens('highest_degree')} AS hd, {O.null_tokens('work_history')} AS wh FROM parsed),
labelled AS (
  SELECT n.candid, n."row", n.name, n.state, n.min_year, n.cm AS college_major, n.ui AS undergraduate_institution,
         n.hd AS highest_degree, n.wh AS work_history, n.sources, n.lang AS party, n.source, n.n_chars,
         l.toxic, l.quality AS accuracy
  FROM nulled n JOIN labels l ON n."row" = l.doc_id)
"""
_LCOLS = ", ".join(f'"{c}"' if c in ("row",) else c for c in LABELLED_COLS)


@register("labelled_all", LABELLED_SQL + f"SELECT {_LCOLS} FROM labelled")
def q_labelled_all(spark, sf_dir):
    return labelled(spark, sf_dir).select(*LABELLED_COLS)


@register("labelled_output_only", LABELLED_SQL + f"""SELECT {_LCOLS} FROM labelled
WHERE college_major IS NOT NULL OR undergraduate_institution IS NOT NULL
   OR highest_degree IS NOT NULL OR work_history IS NOT NULL""")
def q_labelled_output_only(spark, sf_dir):
    return Q.include(labelled(spark, sf_dir), "output", P.FOUR_FIELDS).select(*LABELLED_COLS)


@register("labelled_since_year", LABELLED_SQL + f"SELECT {_LCOLS} FROM labelled WHERE min_year >= {SINCE_YEAR}")
def q_labelled_since_year(spark, sf_dir):
    return Q.include(labelled(spark, sf_dir), "years", P.FOUR_FIELDS, since=SINCE_YEAR).select(*LABELLED_COLS)


def _codes_sql(cols, src="labelled"):
    items = [f"CAST(CASE WHEN {c} IS NULL THEN -1 ELSE dense_rank() OVER (PARTITION BY {c} IS NULL ORDER BY {c}) - 1 END "
             f"AS INTEGER) AS {c}_code" for c in cols]
    return ",\n  ".join(items)


@register("encode_categories", LABELLED_SQL + f"""
SELECT "row", {_codes_sql(CATEGORY_COLS)}, min_year, accuracy FROM labelled""")
def q_encode_categories(spark, sf_dir):
    df = labelled(spark, sf_dir).select("row", *CATEGORY_COLS, "min_year", "accuracy")
    df = RK.dense_codes_many(df, CATEGORY_COLS)
    return df.select("row", *[f"{c}_code" for c in CATEGORY_COLS], "min_year", "accuracy")


def ml_raw(spark, sf_dir):
    d = V.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = V.table(spark, sf_dir, "labels")
    return lab.join(d, "doc_id").select("doc_id", "lang", "source", "n_chars", "toxic",
                                        F.col("quality").alias("label"))


def ml_set(spark, sf_dir):
    """labels x documents with encoded categorical features (all rows)."""
    return RK.dense_codes_many(ml_raw(spark, sf_dir), ("lang", "source")).drop("lang", "source")


ML_FEATURES = ("lang_code", "source_code", "n_chars", "toxic")


@register("ml_features", """
WITH s AS (SELECT l.doc_id, d.lang, d.source, d.n_chars, l.toxic, l.quality AS label
           FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
SELECT doc_id, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS lang_code,
       CAST(dense_rank() OVER (ORDER BY source) - 1 AS INTEGER) AS source_code, n_chars, toxic, label FROM s""")
def q_ml_features(spark, sf_dir):
    return ml_set(spark, sf_dir).select("doc_id", *ML_FEATURES, "label")


def _scored(spark, sf_dir):
    return labelled(spark, sf_dir).select("row", F.col("accuracy").alias("y"), _rule().alias("p"), "min_year")


SCORED_SQL = LABELLED_SQL.rstrip() + f""",
scored AS (SELECT "row", accuracy AS y, {RULE_SQL} AS p, min_year FROM labelled)
"""


@register("eval_accuracy", SCORED_SQL + "SELECT count(*) AS n, round(avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM scored")
def q_eval_accuracy(spark, sf_dir):
    return Q.accuracy(_scored(spark, sf_dir))


@register("eval_confusion", SCORED_SQL + """
SELECT g.y, g.p, count(s.y) AS n FROM (SELECT * FROM (VALUES (0), (1)) a(y), (VALUES (0), (1)) b(p)) g
LEFT JOIN scored s ON s.y = g.y AND s.p = g.p GROUP BY g.y, g.p""")
def q_eval_confusion(spark, sf_dir):
    return Q.confusion(_scored(spark, sf_dir))


REPORT_SQL = SCORED_SQL.rstrip() + """,
cls AS (SELECT * FROM (VALUES (0), (1)) c(label)),
per AS (SELECT c.label,
  sum(CASE WHEN s.y = c.label AND s.p = c.label THEN 1 ELSE 0 END) AS tp,
  sum(CASE WHEN s.p = c.label THEN 1 ELSE 0 END) AS predicted,
  sum(CASE WHEN s.y = c.label THEN 1 ELSE 0 END) AS support
  FROM cls c, scored s GROUP BY c.label),
pr AS (SELECT label, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, support FROM per),
rep AS (SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall,
   round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END, 6) AS f1,
   CAST(support AS BIGINT) AS support FROM pr)
"""


@register("eval_report", REPORT_SQL + "SELECT * FROM rep")
def q_eval_report(spark, sf_dir):
    return Q.report(_scored(spark, sf_dir))


@register("eval_report_avg", REPORT_SQL.rstrip() + """,
whole AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM pr)
SELECT 'macro avg' AS average, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall,
       round(avg(f1), 6) AS f1, CAST(sum(support) AS BIGINT) AS support FROM whole
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
       round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM whole""")
def q_eval_report_avg(spark, sf_dir):
    return Q.report_averages(_scored(spark, sf_dir))


FOLDS_SQL = SCORED_SQL.rstrip() + f""",
folds AS (SELECT *, CAST((row_number() OVER (PARTITION BY y ORDER BY md5('{FOLD_SEED}:' || CAST("row" AS VARCHAR)), "row") - 1)
                        % {FOLDS} AS INTEGER) AS fold FROM scored)
"""


@register("stratified_folds", FOLDS_SQL + 'SELECT "row", y, fold FROM folds')
def q_stratified_folds(spark, sf_dir):
    return RK.stratified_folds(_scored(spark, sf_dir), "y", "row", FOLDS, FOLD_SEED).select("row", "y", "fold")


@register("eval_fold_f1", FOLDS_SQL + """,
per AS (SELECT fold,
  CASE WHEN 2 * sum(CASE WHEN y = 1 AND p = 1 THEN 1 ELSE 0 END) + sum(CASE WHEN y <> 1 AND p = 1 THEN 1 ELSE 0 END)
            + sum(CASE WHEN y = 1 AND p <> 1 THEN 1 ELSE 0 END) > 0
       THEN 2 * sum(CASE WHEN y = 1 AND p = 1 THEN 1 ELSE 0 END)
            / (2 * sum(CASE WHEN y = 1 AND p = 1 THEN 1 ELSE 0 END) + sum(CASE WHEN y <> 1 AND p = 1 THEN 1 ELSE 0 END)
               + sum(CASE WHEN y = 1 AND p <> 1 THEN 1 ELSE 0 END))
       ELSE 0.0 END AS f1 FROM folds GROUP BY fold)
SELECT CAST(fold AS VARCHAR) AS fold, round(f1, 6) AS f1 FROM per
UNION ALL SELECT 'mean', round(avg(f1), 6) FROM per""")
def q_eval_fold_f1(spark, sf_dir):
    f = RK.stratified_folds(_scored(spark, sf_dir), "y", "row", FOLDS, FOLD_SEED)
    return Q.fold_f1(f)


@register("holdout_split", SCORED_SQL.rstrip() + f""",
h AS (SELECT "row", row_number() OVER (ORDER BY md5('{SPLIT_SEED}:' || CAST("row" AS VARCHAR)), "row") - 1 AS r,
             count(*) OVER () AS n FROM scored)
SELECT "row", CASE WHEN r < ceil({TEST_FRACTION} * n) THEN 'test' ELSE 'train' END AS part FROM h""")
def q_holdout_split(spark, sf_dir):
    return RK.holdout_split(_scored(spark, sf_dir), "row", TEST_FRACTION, SPLIT_SEED).select("row", "part")


@register("coverage_by_year", REPLIES_SQL + f""",
flags AS (SELECT min_year, ({O.null_tokens('college_major')} IS NOT NULL OR {O.null_tokens('undergraduate_institution')} IS NOT NULL
                  OR {O.null_tokens('highest_degree')} IS NOT NULL OR {O.null_tokens('work_history')} IS NOT NULL) AS has_output
          FROM parsed)
SELECT min_year, count(*) AS entities, CAST(sum(CAST(has_output AS BIGINT)) AS BIGINT) AS covered,
       round(sum(CAST(has_output AS BIGINT)) / count(*), 6) AS coverage
FROM flags GROUP BY ROLLUP (min_year)""")
def q_coverage_by_year(spark, sf_dir):
    parsed = P.null_answer_tokens(P.parse_replies(V.replies(spark, sf_dir), "response"))
    flags = parsed.select("min_year", P.has_output().alias("has_output"))
    return Q.coverage_by(flags, "min_year", "has_output")


@register("accuracy_by_period", LABELLED_SQL + f"""
SELECT 'all' AS period, count(*) AS n, round(avg(accuracy), 6) AS accuracy FROM labelled
UNION ALL
SELECT '{SINCE_YEAR}+', count(*), round(avg(accuracy), 6) FROM labelled WHERE min_year >= {SINCE_YEAR}""")
def q_accuracy_by_period(spark, sf_dir):
    lab = labelled(spark, sf_dir)
    since = F.col("min_year") >= SINCE_YEAR
    return lab.select(F.explode(F.array(
        F.struct(F.lit("all").alias("period"), F.col("accuracy").alias("a")),
        F.when(since, F.struct(F.lit(f"{SINCE_YEAR}+").alias("period"), F.col("accuracy").alias("a"))),
    )).alias("x")).where(F.col("x").isNotNull()).groupBy("x.period").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("x.a"), 6).alias("accuracy"))


@register("eval_validation", SCORED_SQL + f"""
SELECT count(*) AS n, round(avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM scored
WHERE "row" >= {VALIDATION_ROW}""")
def q_eval_validation(spark, sf_dir):
    return Q.accuracy(_scored(spark, sf_dir).filter(F.col("row") >= VALIDATION_ROW))


# --- k-NN on the embedding table -------------------------------------------------

def vectors(spark, sf_dir):
    e = spread(V.table(spark, sf_dir, "embeddings"))
    test = (F.col("vec_id") % 7) == 0
    return e.filter(~test), e.filter(test)


_DIM = 64
KNN_SQL = f"""
WITH tr AS (SELECT vec_id, label, embedding FROM embeddings WHERE vec_id % 7 <> 0),
te AS (SELECT vec_id, label, embedding FROM embeddings WHERE vec_id % 7 = 0),
d AS (SELECT te.vec_id AS q_id, te.label AS actual, tr.vec_id AS t_id, tr.label AS t_label,
             list_sum(list_transform(range(1, {_DIM + 1}),
               lambda i: (CAST(te.embedding[i] AS DOUBLE) - CAST(tr.embedding[i] AS DOUBLE)) ** 2)) AS d2
      FROM te, tr),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY d2, t_id) AS r FROM d) WHERE r <= {KNN_K}),
votes AS (SELECT q_id, actual, t_label, count(*) AS votes FROM nn GROUP BY q_id, actual, t_label),
best AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY votes DESC, t_label) AS r FROM votes)
"""


def _knn(spark, sf_dir):
    train, test = vectors(spark, sf_dir)
    pred = Q.knn_vote(knn_pivots(train, test, k=KNN_K))
    return pred.join(test.select(F.col("vec_id").alias("q_id"), F.col("label").alias("actual")), "q_id")


@register("knn_classify", KNN_SQL + "SELECT q_id, actual, t_label AS predicted, votes FROM best WHERE r = 1")
def q_knn_classify(spark, sf_dir):
    return _knn(spark, sf_dir).select("q_id", "actual", "predicted", "votes")


# --- MLlib models: fit, cross-validate, validate --------------------------------------

MODEL_FEATURES = (*(f"{c}_code" for c in CATEGORY_COLS), "min_year")


def model_rows(spark, sf_dir):
    """The labelled set, written once: every split and model reads it."""
    rows = labelled(spark, sf_dir).select("row", *CATEGORY_COLS, "min_year", F.col("accuracy").alias("y"))
    return materialize(rows, "model-rows")


def coded(train, test):
    """Both with category codes fitted on the training rows only."""
    codes = RK.fit_codes(train, CATEGORY_COLS)
    return tuple(RK.apply_codes(x, codes, CATEGORY_COLS) for x in (train, test))


def predictions(kind, train, test):
    """``test`` with a prediction ``p`` of a model fitted on ``train``, both coded."""
    return M.fit_predict(train, test, MODEL_FEATURES, "y", kind).select(
        "row", F.col("y").cast("int").alias("y"), F.col("prediction").alias("p"))


def fitted_on(kind):
    """(train, test) -> test with a prediction ``p``; category codes are
    fitted on the training rows only."""
    return lambda train, test: predictions(kind, *coded(train, test))


def held_out_predictions(spark, sf_dir, kind):
    s = RK.holdout_split(model_rows(spark, sf_dir), "row", TEST_FRACTION, SPLIT_SEED)
    return fitted_on(kind)(s.filter(F.col("part") == "train"), s.filter(F.col("part") == "test"))


def _model(spark, sf_dir, kind):
    out = held_out_predictions(spark, sf_dir, kind)
    return out.select("row", F.col("y").alias("label"), F.col("p").isin(0, 1).cast("int").alias("known_class"))


#: SQL states no trained model: the test rows, their labels, and that the prediction is a class.
MODEL_SQL = SCORED_SQL.rstrip() + f""",
h AS (SELECT "row", y, row_number() OVER (ORDER BY md5('{SPLIT_SEED}:' || CAST("row" AS VARCHAR)), "row") - 1 AS r,
             count(*) OVER () AS n FROM scored)
SELECT "row", CAST(y AS INTEGER) AS label, CAST(1 AS INTEGER) AS known_class FROM h WHERE r < ceil({TEST_FRACTION} * n)"""


@register("ml_random_forest", MODEL_SQL)
def q_ml_random_forest(spark, sf_dir):
    return _model(spark, sf_dir, "RF")


@register("ml_gbt", MODEL_SQL)
def q_ml_gbt(spark, sf_dir):
    return _model(spark, sf_dir, "XG")


@register("ml_mlp", MODEL_SQL)
def q_ml_mlp(spark, sf_dir):
    return _model(spark, sf_dir, "NN")


#: Kinds that are fitted five times anew; boosted trees are judged on held-out rows only.
CROSS_VALIDATED = ("RF", "NN", "KN")


@register("ml_cross_validation")
def q_ml_cross_validation(spark, sf_dir):
    """f1 per kind of model and fold, fitted anew on the other folds, and the mean."""
    folds = RK.stratified_folds(RK.ranked(model_rows(spark, sf_dir), CATEGORY_COLS), "y", "row", FOLDS, FOLD_SEED)
    folds = materialize(folds, "folds")
    # the codes of a fold are fitted and joined once, whatever the kinds that read them
    columns = ("row", "y", *MODEL_FEATURES)
    parts = [[materialize(x.select(*columns), "fold-codes") for x in coded(folds.filter(F.col("fold") != k),
                                                                          folds.filter(F.col("fold") == k))]
             for k in range(FOLDS)]
    out = None
    for kind in CROSS_VALIDATED:
        scored = materialize(reduce(DataFrame.unionByName, [predictions(kind, *p) for p in parts]), "scored")
        f1 = Q.fold_f1(scored.join(folds.select("row", "fold"), "row")).withColumn("kind", F.lit(kind))
        out = f1 if out is None else out.unionByName(f1)
    return out


@register("ml_validation")
def q_ml_validation(spark, sf_dir):
    """Report of each kind of model trained on the rows before VALIDATION_ROW, on those from it on."""
    rows = model_rows(spark, sf_dir)
    late = F.col("row") >= VALIDATION_ROW
    columns = ("row", "y", *MODEL_FEATURES)
    train, test = (materialize(x.select(*columns), "validation-codes") for x in coded(rows.filter(~late), rows.filter(late)))
    out = None
    for kind in M.MODELS:
        report = Q.report(materialize(predictions(kind, train, test), "validated")).withColumn("kind", F.lit(kind))
        out = report if out is None else out.unionByName(report)
    return out
