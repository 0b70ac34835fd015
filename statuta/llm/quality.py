"""Quality classifier: a sparse ensemble of rules over text statistics.

Trees grown on the statistics of labelled rows give conjunctive rules, one for each path from the
root; a logistic regression with an L1 penalty weighs the rules and leaves most at zero. The rest is
compiled into one Spark column expression, so scoring stays in the JVM.

At most `train_rows` labelled rows are learned from, chosen by a hash; of equal ones only one counts. Null and empty texts have
zero statistics and are scored as any other; null labels are ignored; without both labels every
score is the share of label 1 (0.5 if there are none). Repeated rows are scored each; other columns
pass through, a column named as a result is replaced. Empty tables give no rows; long texts are read whole.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.llm.common import at_most, checkpointed, words

TRAIN_ROWS = 20_000
TREES, DEPTH, PENALTY = 12, 3, 0.002
STATS = ["words", "word_length", "distinct", "repeated", "upper", "symbols", "digits", "marks", "bars", "bangs", "line_words"]


def statistics(text: Column) -> Column:
    """Struct of the statistics of a text."""
    whole = F.coalesce(text, F.lit(""))

    def of(found: Column) -> Column:
        n = F.greatest(F.size(found), F.lit(1))
        chars = F.greatest(F.char_length(whole), F.lit(1))
        same = F.size(F.filter(F.sequence(F.lit(0), F.size(found)), lambda i: F.get(found, i) == F.get(found, i + 1)))
        count = lambda pattern: F.regexp_count(whole, F.lit(pattern))
        values = {
            "words": F.log1p(F.size(found)),
            "word_length": chars / n,
            "distinct": F.size(F.array_distinct(found)) / n,
            "repeated": same / n,
            "upper": count(r"\p{Lu}") / chars,
            "symbols": count(r"[#$%&*@^~<>{}\[\]]") / n,
            "digits": count("[0-9]") / chars,
            "marks": count("[.,;:?]") / n,
            "bars": count(r"\|") / n,
            "bangs": count("!") / n,
            "line_words": F.log1p(n / (count("\n") + 1)),
        }
        return F.struct(*[values[k].cast("double").alias(k) for k in STATS])

    return F.transform(F.array(words(whole)), of)[0]


def tree_rules(debug: str) -> list[tuple[tuple[int, bool, float], ...]]:
    """Conjunctions of (feature, at most?, threshold): all paths of a tree's printed form."""
    rules, path = [], []
    for line in debug.splitlines():
        found = re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)", line)
        if found:
            path = [x for x in path if x[0] < len(found[1])]
            path.append((len(found[1]), (int(found[2]), found[3] == "<=", float(found[4]))))
            rules.append(tuple(t for _, t in path))
    return rules


def rule_column(rule, stats: str = "stats") -> Column:
    """A rule as a condition on the struct column of statistics."""
    terms = [(F.col(stats)[STATS[f]] <= t) if low else (F.col(stats)[STATS[f]] > t) for f, low, t in rule]
    out = terms[0]
    for t in terms[1:]:
        out = out & t
    return out


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[float, list]:
    """Bias and (rule, weight) list from at most `train_rows` rows of `labels` (doc_id, quality)."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "quality")
    sample = at_most(usable.distinct(), "doc_id", train_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select(statistics(F.col("text")).alias("stats"), F.col("quality").cast("double").alias("quality"))
    # The scan keeps its tasks; only the few labelled rows are dealt anew.
    rows = checkpointed(rows.repartition(12))
    counts = {int(r["quality"]): r["count"] for r in rows.groupBy("quality").count().collect()}
    good, bad = counts.get(1, 0), counts.get(0, 0)
    if not good or not bad:
        share = min(max((good + 0.5) / (good + bad + 1), 1e-6), 1 - 1e-6)
        return math.log(share / (1 - share)), []
    flat = VectorAssembler(inputCols=STATS, outputCol="features").transform(rows.select("quality", "stats.*"))
    forest = RandomForestClassifier(labelCol="quality", numTrees=TREES, maxDepth=DEPTH, seed=7, featureSubsetStrategy="onethird").fit(flat)
    rules = sorted({r for tree in forest.trees for r in tree_rules(tree.toDebugString)})
    if not rules:
        return math.log(good / bad), []
    truth = rows.select("quality", *[rule_column(r).cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    ruled = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(truth).select("quality", "features")
    lasso = LogisticRegression(labelCol="quality", elasticNetParam=1.0, regParam=PENALTY, maxIter=40, standardization=False).fit(ruled)
    return float(lasso.intercept), [(r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray(), strict=True) if w]


def compiled(bias: float, weighted: list, stats: str = "stats") -> Column:
    """The score as one column expression."""
    z = F.lit(bias)
    for rule, weight in weighted:
        z = z + F.when(rule_column(rule, stats), F.lit(weight)).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """`docs` with score and predicted (1 if score >= threshold)."""
    bias, weighted = fit(docs, labels, train_rows)
    held = docs.withColumn("__stats", statistics(F.col("text")))
    return held.withColumn("score", compiled(bias, weighted, "__stats")).withColumn("predicted", (F.col("score") >= threshold).cast("int")).drop("__stats")
