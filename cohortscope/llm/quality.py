"""Quality: a sparse rule ensemble over text statistics, compiled to a column expression.

Trees are grown on statistics of labelled documents, each path from a root to a node becomes a
conjunctive rule, a lasso logistic regression keeps few of the rules, and what it keeps is
written as one SQL expression over the statistics.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.llm.scratch import Scratch
from cohortscope.llm.texts import crc_fold, whole_text

#: Statistics of a text t and its words w (array), by name.
STATISTICS = {
    "n_words": "CAST(size(w) AS DOUBLE)",
    "mean_word": "char_length(t) / greatest(size(w), 1)",
    "distinct_words": "size(array_distinct(w)) / greatest(size(w), 1)",
    "upper": "regexp_count(t, '\\\\p{Lu}') / greatest(char_length(t), 1)",
    "letters": "regexp_count(t, '\\\\p{L}') / greatest(char_length(t), 1)",
    "digits": "regexp_count(t, '[0-9]') / greatest(char_length(t), 1)",
    "marks": "regexp_count(t, '[.,;:?]') / greatest(size(w), 1)",
    "shouts": "regexp_count(t, '!') / greatest(size(w), 1)",
    "bars": "regexp_count(t, '[|<>{}=_]') / greatest(size(w), 1)",
    "symbols": "regexp_count(t, '[#$%&*@~^]') / greatest(size(w), 1)",
    "line_words": "size(w) / greatest(regexp_count(t, '[^\\n]+'), 1)",
}
#: Bound on the labelled rows that the classifier is fitted on, taken by hash of the id.
FIT_ROWS = 200_000
TREES, DEPTH, LASSO, SEED = 24, 3, 0.002, 17


@dataclass(frozen=True)
class RuleModel:
    """Conjunctive rules as SQL conditions with their weights, and the intercept."""

    rules: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float

    def score(self) -> str:
        """SQL of the probability of label 1, over the statistics' columns."""
        terms = [f"CASE WHEN {r} THEN {w!r}D ELSE 0D END" for r, w in zip(self.rules, self.weights)]
        return f"1 / (1 + exp(-({' + '.join([f'{self.intercept!r}D', *terms])})))"


def text_statistics(docs: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """doc_id, the extra columns and one DOUBLE column per statistic."""
    words = F.expr(r"filter(split(t, '[\\x20\\x09-\\x0D]+'), x -> x != '')")
    texts = docs.select("doc_id", *extra, whole_text().alias("t")).withColumn("w", words)
    return texts.selectExpr(
        "doc_id", *extra, *[f"CAST({sql} AS DOUBLE) AS {name}" for name, sql in STATISTICS.items()]
    )


def tree_rules(text: str, names: Sequence[str]) -> list[str]:
    """The paths of a forest's description as SQL conditions, without repetition.

    Every node but the roots gives a rule; of a root's two branches only one, as the other
    says the same.
    """
    rules: dict[str, None] = {}
    path: list[str] = []
    for line in text.splitlines():
        found = re.match(r"( +)(If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if found:
            depth = len(found[1]) - 4
            condition = f"{names[int(found[3])]} {found[4]} {float(found[5])!r}D"
            path = [*path[:depth], condition]
            if depth or found[2] == "If":
                rules[" AND ".join(dict.fromkeys(path))] = None
    return list(rules)


def bounded(labelled: DataFrame, rows: int) -> DataFrame:
    """At most about that many rows, the same ones whenever the ids are the same."""
    total = labelled.count()
    if total <= rows:
        return labelled
    return labelled.where(F.expr(f"pmod(xxhash64(doc_id), {1 << 30}) < {(1 << 30) * rows // total}"))


def fit_rules(labelled: DataFrame, names: Sequence[str] = tuple(STATISTICS)) -> RuleModel:
    """Fits forest and lasso on rows with a column ``label`` (0 or 1) and the statistics.

    Without labelled rows the model gives 0.5 everywhere; with one class, a score near it.
    """
    counts = {int(r["label"]): r["count"] for r in labelled.groupBy("label").count().collect()}
    if not counts:
        return RuleModel((), (), 0.0)
    if len(counts) == 1:
        return RuleModel((), (), 4.0 if 1 in counts else -4.0)
    vectors = VectorAssembler(inputCols=list(names), outputCol="features")
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, minInstancesPerNode=5, featureSubsetStrategy="0.5"
    ).fit(vectors.transform(labelled.select(*names, "label")))
    rules = tree_rules(forest.toDebugString, names)
    if not rules:
        return RuleModel((), (), 0.0)
    columns = [f"CASE WHEN {rule} THEN 1D ELSE 0D END AS rule_{i}" for i, rule in enumerate(rules)]
    fired = VectorAssembler(inputCols=[f"rule_{i}" for i in range(len(rules))], outputCol="features")
    lasso = LogisticRegression(regParam=LASSO, elasticNetParam=1.0, maxIter=100).fit(
        fired.transform(labelled.selectExpr("label", *columns)).select("label", "features")
    )
    kept = [(r, float(w)) for r, w in zip(rules, lasso.coefficients) if w]
    return RuleModel(
        tuple(r for r, _ in kept), tuple(w for _, w in kept), float(lasso.intercept)
    )


def fit_quality(
    stats: DataFrame, labels: DataFrame, scratch: Scratch, folds: int, held: int, fit_rows: int
) -> RuleModel:
    """The model learnt from labels of all folds but the held one."""
    known = labels.select("doc_id", F.col("quality").cast("double").alias("label")).where(
        (crc_fold("doc_id", folds) != held) & F.col("label").isNotNull()
    )
    return fit_rules(scratch.store(bounded(stats.join(known, "doc_id"), fit_rows), "labelled"))


def score_quality(
    docs: DataFrame, labels: DataFrame, *, folds: int = 3, held: int = 1, limit: float = 0.5,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted.

    Labels of ids whose crc32 fold is ``held`` are never learnt from. The statistics of all
    documents are computed once, by Spark expressions on whole texts, and the model is fitted
    on at most about ``fit_rows`` labelled rows of them.

    Null text: as an empty one, which has a score too. Null ids have no label and are in the
    fold of the empty text. Null labels are left out; contradicting ones all count. No labels:
    score 0.5. Empty table: no rows. Repeated rows are scored each. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    stats = scratch.store(text_statistics(docs.select("doc_id", "text")), "statistics")
    model = fit_quality(stats, labels, scratch, folds, held, fit_rows)
    scored = stats.selectExpr("doc_id", f"{model.score()} AS score")
    return scored.select(
        "doc_id",
        (crc_fold("doc_id", folds) == held).alias("held_out"),
        "score",
        (F.col("score") >= limit).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, *, folds: int = 3, held: int = 1, limit: float = 0.5,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """Rows of docs that the classifier accepts, with all their columns and without a shuffle."""
    scratch = Scratch(docs.sparkSession, "quality")
    stats = scratch.store(text_statistics(docs.select("doc_id", "text")), "statistics")
    model = fit_quality(stats, labels, scratch, folds, held, fit_rows)
    whole = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"), "doc_id", "text")
    return text_statistics(whole, ["row"]).where(f"{model.score()} >= {limit!r}D").select("row.*")
