"""Agreement between true and predicted classes: kappa, accuracy, report, losses.

All metrics of one prediction set come from one aggregate: a K x K confusion array per
group, summed map-side, after which everything is arithmetic on one row per group.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, functions as F


def _ratio(top: Column, bottom: Column) -> Column:
    """Division in doubles; null where the bottom is zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def _kappa(n: Column, sy: Column, sp: Column, syy: Column, spp: Column, syp: Column) -> Column:
    """Quadratic weighted kappa from the six moments; null when both sides are constant."""
    n, sy, sp, syy, spp, syp = (c.cast("double") for c in (n, sy, sp, syy, spp, syp))
    disagreement = n * (syy + spp - F.lit(2.0) * syp)
    by_chance = n * (syy + spp) - F.lit(2.0) * sy * sp
    return F.lit(1.0) - F.try_divide(disagreement, by_chance)


def confusion(df: DataFrame, y: str, p: str, num_classes: int = 5, by: list[str] | None = None,
              *extra: Column) -> DataFrame:
    """One row per group: ``cells`` = counts of (y, p) at position y * K + p.

    Labels outside 0..K-1 would vanish from the cells, so they raise instead. Rows with a
    null on either side are not compared. ``extra`` aggregates of the same rows ride along.
    """
    inside = [F.count_if((F.col(y) == i) & (F.col(p) == j)) for i in range(num_classes) for j in range(num_classes)]
    both = F.count_if(F.col(y).isNotNull() & F.col(p).isNotNull())
    cells = F.array(*inside)
    checked = (F.when(both == reduce(add, inside), cells)
               .otherwise(F.raise_error(F.lit(f"a class label lies outside 0..{num_classes - 1}"))))
    return df.groupBy(*(by or [])).agg(checked.alias("cells"), *extra)


def _derive(counted: DataFrame, num_classes: int) -> DataFrame:
    """Adds what all scores need to a ``confusion`` table, in steps that keep expressions small:
    row sums ``_t``, column sums ``_d``, hits ``_h``, total ``_n`` and per-class score arrays."""
    classes = range(num_classes)
    cell = lambda i, j: F.col("cells")[i * num_classes + j]
    sums = counted.withColumns({
        "_t": F.array(*[reduce(add, [cell(i, j) for j in classes]) for i in classes]),
        "_d": F.array(*[reduce(add, [cell(i, j) for i in classes]) for j in classes]),
        "_h": F.array(*[cell(i, i) for i in classes])})
    score = lambda top, bottom: F.coalesce(_ratio(top, bottom), F.lit(0.0))
    t, d, h = F.col("_t"), F.col("_d"), F.col("_h")
    return sums.withColumns({
        "_n": reduce(add, [t[i] for i in classes]),
        "_hits": reduce(add, [h[i] for i in classes]),
        "_precision": F.array(*[score(h[i], d[i]) for i in classes]),
        "_recall": F.array(*[score(h[i], t[i]) for i in classes]),
        "_f1": F.array(*[score(h[i] * 2, t[i] + d[i]) for i in classes]),
        "_seen": F.array(*[((t[i] + d[i]) > 0).cast("bigint") for i in classes])})


def _derived_accuracy() -> Column:
    return _ratio(F.col("_hits"), F.col("_n"))


def _with_qwk(derived: DataFrame, num_classes: int) -> DataFrame:
    """Adds ``qwk``: classes seen on neither side are left out before numbering them."""
    classes = range(num_classes)
    seen, t, d = F.col("_seen"), F.col("_t"), F.col("_d")
    numbered = derived.withColumn("_r", F.array(
        *[reduce(add, [seen[j] for j in range(i)], F.lit(0).cast("bigint")) for i in classes]))
    r, total = F.col("_r"), lambda terms: reduce(add, terms)
    cross = [F.col("cells")[i * num_classes + j] * r[i] * r[j] for i in classes for j in classes]
    moments = numbered.withColumns({
        "_sy": total([t[i] * r[i] for i in classes]), "_syy": total([t[i] * r[i] * r[i] for i in classes]),
        "_sp": total([d[i] * r[i] for i in classes]), "_spp": total([d[i] * r[i] * r[i] for i in classes]),
        "_syp": total(cross)})
    return moments.withColumn("qwk", _kappa(*[F.col(c) for c in ("_n", "_sy", "_sp", "_syy", "_spp", "_syp")]))


def confusion_matrix(df: DataFrame, y: str, p: str, num_classes: int = 5,
                     by: list[str] | None = None) -> DataFrame:
    """(y, p, n) for all K x K pairs, zero counts included."""
    by = by or []
    cells = confusion(df, y, p, num_classes, by).select(*by, F.posexplode("cells").alias("_at", "n"))
    return cells.select(*by, F.expr(f"_at div {num_classes}").cast("int").alias("y"),
                        (F.col("_at") % num_classes).alias("p"), "n")


def accuracy(df: DataFrame, y: str, p: str, by: list[str] | None = None) -> DataFrame:
    by = by or []
    return df.groupBy(*by).agg(F.avg((F.col(y) == F.col(p)).cast("int")).alias("accuracy"))


def qwk(df: DataFrame, y: str, p: str, by: list[str] | None = None, labels: str = "present",
        count: str | None = None) -> DataFrame:
    """Quadratic weighted kappa of two integer columns with any label values.

    ``count`` names a column of multiplicities where equal pairs are already merged.

    ``fixed`` uses the label values in one aggregate. ``present`` first numbers the labels
    that occur: rows shrink to one per (group, y, p) map-side, and only those are ranked.
    """
    by = by or []
    n = (F.col(count) if count else F.lit(1)).cast("bigint")
    # a filter on computed labels would compute them twice, so unpaired rows just weigh nothing
    n = F.when(F.col(y).isNotNull() & F.col(p).isNotNull(), n)
    if labels == "fixed":
        return _from_moments(df, by, n, F.col(y).cast("bigint"), F.col(p).cast("bigint"))
    if labels != "present":
        raise ValueError("labels must be 'present' or 'fixed'")
    pairs = (df.groupBy(*by, F.col(y).alias("_y"), F.col(p).alias("_p"))
             .agg(F.sum(n).alias("_n")).where(F.col("_n").isNotNull()))
    sides = pairs.select("*", F.posexplode(F.array("_y", "_p")).alias("_side", "_label"))
    places = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_label")
    ranked = (sides.withColumn("_rank", F.dense_rank().over(places).cast("bigint"))
              .groupBy(*by, "_y", "_p", "_n")
              .agg(F.max(F.when(F.col("_side") == 0, F.col("_rank"))).alias("_a"),
                   F.max(F.when(F.col("_side") == 1, F.col("_rank"))).alias("_b")))
    return _from_moments(ranked, by, F.col("_n"), F.col("_a"), F.col("_b"))


def _from_moments(df: DataFrame, by: list[str], n: Column, a: Column, b: Column) -> DataFrame:
    moments = df.groupBy(*by).agg(
        F.sum(n).alias("_n"), F.sum(n * a).alias("_sy"), F.sum(n * b).alias("_sp"),
        F.sum(n * a * a).alias("_syy"), F.sum(n * b * b).alias("_spp"), F.sum(n * a * b).alias("_syp"))
    kappa = _kappa(*(F.col(c) for c in ("_n", "_sy", "_sp", "_syy", "_spp", "_syp")))
    return moments.select(*by, kappa.alias("qwk"))


def _report_rows(num_classes: int) -> list[Column]:
    """One struct per report line, over the columns ``_derive`` adds."""
    classes = range(num_classes)
    scores = [F.col(c) for c in ("_precision", "_recall", "_f1")]
    support, n = F.col("_t"), F.col("_n")

    def line(name: str, precision: Column, recall: Column, f1: Column, size: Column) -> Column:
        return F.struct(F.lit(name).alias("class"), precision.alias("precision"), recall.alias("recall"),
                        f1.alias("f1"), size.alias("support"))

    macro = [reduce(add, [s[i] for i in classes]) / F.lit(float(num_classes)) for s in scores]
    weighted = [F.coalesce(_ratio(reduce(add, [s[i] * support[i] for i in classes]), n), F.lit(0.0)) for s in scores]
    blank = F.lit(None).cast("double")
    return [*[line(str(i), *[s[i] for s in scores], support[i]) for i in classes],
            # the overall accuracy stands in the f1 column, as printed reports show it
            line("accuracy", blank, blank, _derived_accuracy(), n),
            line("macro avg", *macro, n), line("weighted avg", *weighted, n)]


def classification_report(df: DataFrame, y: str, p: str, num_classes: int = 5,
                          by: list[str] | None = None) -> DataFrame:
    """(class, precision, recall, f1, support): one row per class, accuracy, two averages."""
    by = by or []
    derived = _derive(confusion(df, y, p, num_classes, by), num_classes)
    return derived.select(*by, F.inline(F.array(*_report_rows(num_classes))))


def evaluate(df: DataFrame, y: str, p: str, num_classes: int = 5) -> DataFrame:
    """(metric, class, value): accuracy, kappa and the whole report in one long table."""
    derived = _with_qwk(_derive(confusion(df, y, p, num_classes), num_classes), num_classes)
    lines = derived.select("qwk", _derived_accuracy().alias("accuracy"),
                           F.posexplode(F.array(*_report_rows(num_classes))).alias("_at", "_line"))

    def entry(metric: str, name: Column, value: Column) -> Column:
        return F.struct(F.lit(metric).alias("metric"), name.alias("class"), value.cast("double").alias("value"))

    per_line = [entry(m, F.col("_line.class"), F.col("_line")[m]) for m in ("precision", "recall", "f1", "support")]
    overall = [entry(m, F.lit("all"), F.col(m)) for m in ("accuracy", "qwk")]
    return lines.select(F.inline(F.when(F.col("_at") == 0, F.array(*overall, *per_line))
                                 .otherwise(F.array(*per_line))))


def epoch_metrics(df: DataFrame, y: str, p: str, loss: str, batch: str, num_classes: int = 5,
                  epoch: str = "epoch") -> DataFrame:
    """(epoch, loss, accuracy, qwk); the loss is the mean of batch means, short last batch too.

    One aggregate per (epoch, batch) carries both the batch loss and the confusion counts up.
    """
    per_batch = confusion(df, y, p, num_classes, [epoch, batch], F.avg(loss).alias("_loss"))
    cells = F.array(*[F.sum(F.col("cells")[i]) for i in range(num_classes * num_classes)])
    per_epoch = per_batch.groupBy(epoch).agg(F.avg("_loss").alias("loss"), cells.alias("cells"))
    judged = _with_qwk(_derive(per_epoch, num_classes), num_classes)
    return judged.select(epoch, "loss", _derived_accuracy().alias("accuracy"), "qwk")
