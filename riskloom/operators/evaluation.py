"""Classification metrics as aggregations over (label, prediction[, score]) columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.prefix import prefix_sums

# Promotion gate.
THRESHOLD_F1 = 0.75
BASELINE_F1 = 0.72


def _div(a, b):
    """a / b with 0 when b == 0 (zero_division=0)."""
    return F.coalesce(F.try_divide(a.cast("double"), F.nullif(b, F.lit(0)).cast("double")), F.lit(0.0))


def _counts(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    y, p = F.col(label), F.col(prediction)
    return pred.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                    F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))


def metrics(pred: DataFrame, label: str = "is_delayed", prediction: str = "prediction") -> DataFrame:
    """f1, precision, recall, accuracy and sample count in one aggregation."""
    c = _counts(pred, label, prediction)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    precision, recall = _div(tp, tp + fp), _div(tp, tp + fn)
    return c.select(
        _div(F.lit(2) * tp, F.lit(2) * tp + fp + fn).alias("f1_score"),
        precision.alias("precision"), recall.alias("recall"),
        _div(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        (tp + fp + fn + tn).cast("long").alias("n_samples"))


def confusion(pred: DataFrame, label: str = "is_delayed", prediction: str = "prediction") -> DataFrame:
    """2x2 matrix as rows (label, prediction, n), zero-filled."""
    c = _counts(pred, label, prediction)
    cells = F.array(*[F.struct(F.lit(lab).alias("label"), F.lit(prd).alias("prediction"), F.col(n).alias("n"))
                      for lab, prd, n in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))])
    return c.select(F.inline(cells)).select("label", "prediction", F.col("n").cast("long"))


def report(pred: DataFrame, label: str = "is_delayed", prediction: str = "prediction") -> DataFrame:
    """Per class precision / recall / f1 / support, plus accuracy, macro and weighted averages."""
    c = _counts(pred, label, prediction)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn

    def cls(name, t, f_p, f_n, support):
        p, r = _div(t, t + f_p), _div(t, t + f_n)
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"),
                        _div(F.lit(2) * p * r, p + r).alias("f1_score"), support.cast("long").alias("support"))

    rows = c.select(F.inline(F.array(cls("0", tn, fn, fp, tn + fp), cls("1", tp, fp, fn, tp + fn))),
                    n.alias("__n"), _div(tp + tn, n).alias("__acc"))
    avg = rows.groupBy().agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
        _div(F.sum(F.col("precision") * F.col("support")), F.sum("support")).alias("wp"),
        _div(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("wr"),
        _div(F.sum(F.col("f1_score") * F.col("support")), F.sum("support")).alias("wf"),
        F.first("__n").alias("n"), F.first("__acc").alias("acc"))
    def row(name, p, r, f):
        return F.struct(F.lit(name).alias("class"), F.col(p).alias("precision"), F.col(r).alias("recall"),
                        F.col(f).alias("f1_score"), F.col("n").cast("long").alias("support"))

    extra = avg.select(F.inline(F.array(row("accuracy", "acc", "acc", "acc"), row("macro avg", "mp", "mr", "mf"),
                                        row("weighted avg", "wp", "wr", "wf"))))
    return rows.drop("__n", "__acc").unionByName(extra)


def roc_auc(pred: DataFrame, label: str = "is_delayed", score: str = "score") -> DataFrame:
    """ROC AUC by rank sums with tied scores sharing credit (Mann-Whitney U).

    Scores are counted per distinct value, and the negatives below each
    score come from prefix sums over as many ranges as there are distinct
    scores to order, so no single task orders the whole table.
    """
    g = (pred.groupBy(F.col(score).cast("double").alias("s"))
         .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")))
    below = prefix_sums(g, [], "s", ["neg"], inclusive=False)
    return below.agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"),
        F.sum(F.col("pos") * (F.col("cum_neg") + F.lit(0.5) * F.col("neg"))).alias("u")).select(
        F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
               F.col("u") / (F.col("n_pos").cast("double") * F.col("n_neg"))).alias("roc_auc"),
        F.col("n_pos").cast("long").alias("n_pos"), F.col("n_neg").cast("long").alias("n_neg"))


def gate(m: DataFrame, threshold: float = THRESHOLD_F1, baseline: float = BASELINE_F1) -> DataFrame:
    """Promotion gate: passes when f1 >= threshold and f1 > baseline (a real boolean)."""
    f1 = F.col("f1_score")
    return m.select(f1.alias("candidate_f1"), F.lit(threshold).alias("threshold_f1"),
                    F.lit(baseline).alias("baseline_f1"), (f1 > F.lit(baseline)).alias("beats_baseline"),
                    (f1 >= F.lit(threshold)).alias("meets_threshold"),
                    ((f1 >= F.lit(threshold)) & (f1 > F.lit(baseline))).alias("passed"),
                    F.round(f1 - F.lit(baseline), 4).alias("improvement_over_baseline"))
