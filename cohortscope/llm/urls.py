"""URL filters: listed rules, and gradient-boosted trees on lexical features for the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortscope.llm.scratch import Scratch
from cohortscope.llm.texts import LOWER, UPPER

#: (verdict, host, path): a rule fits its host and all subdomains where the path starts with its own.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Bound on the labelled URLs that the trees are fitted on, taken by hash; and the trees.
FIT_ROWS, TREES, DEPTH, SEED = 100_000, 12, 4, 29
#: Folds of the labelled URLs: statistics of a URL's suffix leave out the URL's fold, and the last
#: fold counts as URLs of unseen suffixes while learning. Weight of the overall block rate in a suffix's rate.
FOLDS, PRIOR = 5, 2

#: Lexical features of url, host, path and query.
FEATURES = {
    "url_length": "length(u)",
    "host_length": "length(host)",
    "path_length": "length(path)",
    "depth": "length(path) - length(replace(path, '/', ''))",
    "labels": "length(host) - length(replace(host, '.', ''))",
    "hyphens": "length(u) - length(replace(u, '-', ''))",
    "digit_ratio": "regexp_count(u, '[0-9]') / greatest(length(u), 1)",
    "host_digits": "regexp_count(host, '[0-9]')",
    "parameters": "CASE WHEN query = '' THEN 0 ELSE 1 + length(query) - length(replace(query, '&', '')) END",
    "query_length": "length(query)",
    "entropy": """aggregate(array_distinct(split(u, '')), 0D, (s, c) -> s - CASE WHEN c = '' THEN 0D ELSE
        (length(u) - length(replace(u, c, ''))) / length(u) * log2((length(u) - length(replace(u, c, ''))) / length(u)) END)""",
    "secure": "CAST(startswith(u, 'https:') AS INT)",
    "page_file": "CAST(path RLIKE '[.][a-z]{3,4}$' AS INT)",
    "fragment": "CAST(instr(u, '#') > 0 AS INT)",
}
#: Host suffixes whose labelled URLs give statistics: the last label, and the last two.
SUFFIXES = {"top": 1, "second": 2}


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path and query; empty where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"^[^?#]*[?]([^#]*)", 1)
    return host, path, query


def rule_match(rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule as text and its verdict, over columns host and path; else null."""
    names, verdicts = [F.lit(None).cast("string")], [F.lit(None).cast("string")]
    for kind, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r)):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))) & F.startswith(
            "path", F.lit(path)
        )
        names.append(F.when(fits, host + path))
        verdicts.append(F.when(fits, kind))
    return F.coalesce(*reversed(names)), F.coalesce(*reversed(verdicts))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    *,
    fit_rows: int = FIT_ROWS,
    learn_from: str = "TRUE",
) -> DataFrame:
    """One row per row of pages: page_id, host, path, rule, verdict, score.

    URLs that a rule fits have the verdict of the longest one and are the labelled URLs. Boosted
    trees learn from them, by lexical features and by the block rates of their host suffixes, and
    judge the others: block where the probability ``score`` is at least a half. ``learn_from``, a
    condition over host and path, restricts what is learnt from, to measure scores on the rest.

    Suffix statistics of a labelled URL come from the labelled URLs of other folds (by hash of host
    and path), so its own label is not among its features. While learning, one fold counts as URLs
    of unseen suffixes, which have the overall block rate and a count of zero: the trees have learnt
    to judge these by their other features.

    Null URLs and URLs without ``://`` have an empty host and path, fit no rule and are judged by
    their features. Labelled URLs of one kind only: that verdict for all; none: allow. Of rules of
    one length the one with the longer host wins. Null and repeated ids: a row each. Empty table:
    no rows. Other columns are ignored.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    url = F.col("url")
    host, path, query = url_parts(url)
    parsed = pages.select(
        "page_id",
        F.coalesce(url, F.lit("")).alias("u"),
        host.alias("host"),
        path.alias("path"),
        query.alias("query"),
    )
    rule, verdict = rule_match(rules)
    suffixes = [F.substring_index("host", ".", -n).alias(name) for name, n in SUFFIXES.items()]
    rows = parsed.select(
        "page_id", "host", "path", rule.alias("rule"), verdict.alias("listed"), *suffixes,
        *[F.expr(f"CAST({sql} AS DOUBLE)").alias(name) for name, sql in FEATURES.items()],
    )
    learnt = f"listed IS NOT NULL AND ({learn_from})"
    fold = f"CASE WHEN {learnt} THEN CAST(pmod(xxhash64(host, path), {FOLDS}) AS INT) END"
    rows = scratch.store(rows.withColumn("fold", F.expr(fold)), "features")
    labels = rows.where("fold IS NOT NULL").withColumn("label", F.expr("CAST(listed = 'block' AS DOUBLE)"))
    kinds = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    total = sum(kinds.values())
    overall = kinds.get(1.0, 0) / max(total, 1)
    names = list(FEATURES)
    for name in SUFFIXES:
        rows = _with_statistics(rows, labels, name, overall)
        names += [f"{name}_rate", f"{name}_seen"]
    rows = scratch.store(rows, "statistics")
    if len(kinds) < 2:
        rows = rows.withColumn("score", F.lit(float(1.0 in kinds)))
    else:
        taken = f"pmod(xxhash64(page_id, host, path), {1 << 50}) < {(1 << 50) * min(fit_rows, total) // total}"
        unseen = {
            f"{name}_{kind}": F.expr(f"IF(fold = {FOLDS - 1}, {value!r}D, {name}_{kind})")
            for name in SUFFIXES
            for kind, value in (("rate", overall), ("seen", 0.0))
        }
        kept = rows.where(f"fold IS NOT NULL AND {taken}").withColumns(
            {"label": F.expr("CAST(listed = 'block' AS DOUBLE)"), **unseen}
        )
        vectors = VectorAssembler(inputCols=names, outputCol="features")
        trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, maxBins=32)
        model = trees.fit(vectors.transform(kept).select("label", "features"))
        rows = model.transform(vectors.transform(rows)).withColumn(
            "score", vector_to_array("probability")[1]
        )
    judged = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return rows.select(
        "page_id", "host", "path", "rule", F.coalesce("listed", judged).alias("verdict"), "score"
    )


def _with_statistics(rows: DataFrame, labels: DataFrame, suffix: str, overall: float) -> DataFrame:
    """Rows with the suffix's block rate and logarithm of its count, the row's own fold left out."""
    folds = range(FOLDS)
    # The key passes through an expression, so that a join may split a hot suffix of the rows.
    counts = labels.groupBy(suffix).agg(
        F.expr(f"array({', '.join(f'count_if(fold = {k})' for k in folds)})").alias("seen"),
        F.expr(f"array({', '.join(f'coalesce(sum(label) FILTER (WHERE fold = {k}), 0D)' for k in folds)})").alias("blocked"),
    ).selectExpr(f"concat({suffix}, '') AS {suffix}", "seen", "blocked")

    def others(counts: str) -> str:
        every = f"aggregate({counts}, 0D, (s, x) -> s + x)"
        return f"coalesce({every} - coalesce(get({counts}, fold), 0), 0D)"

    rate = f"({others('blocked')} + {PRIOR * overall!r}D) / ({others('seen')} + {PRIOR})"
    return rows.join(counts, suffix, "left").selectExpr(
        *rows.columns, f"{rate} AS {suffix}_rate", f"ln(1 + {others('seen')}) AS {suffix}_seen"
    )
