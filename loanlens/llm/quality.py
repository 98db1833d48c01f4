"""Document quality by a sparse ensemble of rules over text statistics.

Statistics of every whole text are columns. A random forest on labelled rows proposes
rules: the conditions on the way to each node of its trees, joined. A lasso logistic
regression weighs the rules and drops most. What is left is compiled into one Spark
column expression over the statistics, so scoring is a projection.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import bounded_batches, cut_lineage, free_memory, free_name, named, row_ranges, text_buffer
from loanlens.llm.ngram_join import word_hashes
from loanlens.operators.trees import node_table

# Classes of bytes whose share of a text is a statistic.
BYTE_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "sentence": b".,;:?'\"-()",
    "shout": b"!",
    "bar": b"|",
    "symbol": b"#$%&*+/<=>@[\\]^_`{}~",
    "space": b" \t\r\n\v\f",
    "line": b"\n",
    "beyond": bytes(range(128, 256)),
}
STATISTICS = (
    "log_bytes",
    "log_words",
    *[f"share_{name}" for name in BYTE_CLASSES],
    "word_bytes",
    "longest_word",
    "distinct_words",
    "commonest_word",
    "repeated_words",
    "lines",
    "distinct_lines",
    "line_bytes",
)


def _line_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the non-empty lines and their rows."""
    other = np.where(data == 10, 32, np.where((data == 32) | ((data >= 9) & (data <= 13)), 95, data))
    return word_hashes(other.astype(np.uint8), offsets)


def _repeats(values: np.ndarray) -> tuple[float, float]:
    """Share of distinct values, and of the commonest one."""
    if len(values) == 0:
        return 1.0, 0.0
    _, counts = np.unique(values, return_counts=True)
    return len(counts) / len(values), float(counts.max()) / len(values)


def text_statistics(text: pa.Array) -> Iterator[list[float]]:
    """The statistics of each text; null is empty, and shares of nothing are 0."""
    table = np.zeros((len(BYTE_CLASSES), 256), bool)
    for k, members in enumerate(BYTE_CLASSES.values()):
        table[k, list(members)] = True
    data, offsets = text_buffer(text)
    for a, b in row_ranges(offsets):
        part, ends = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        # Counts of every byte value per row.
        rows = np.repeat(np.arange(b - a), np.diff(ends))
        counts = np.bincount(rows * 256 + part, minlength=(b - a) * 256).reshape(-1, 256)
        shares = counts @ table.T.astype(np.int64) / np.maximum(1, np.diff(ends))[:, None]
        words, word_rows = word_hashes(part, ends)
        lines, line_rows = _line_hashes(part, ends)
        longest = _longest_words(part, ends, word_rows, b - a)
        word_ends = np.searchsorted(word_rows, np.arange(b - a), "right").tolist()
        line_ends = np.searchsorted(line_rows, np.arange(b - a), "right").tolist()
        w0 = l0 = 0
        for i, (w1, l1) in enumerate(zip(word_ends, line_ends)):
            size, own, own_lines = int(ends[i + 1] - ends[i]), words[w0:w1], lines[l0:l1]
            distinct, commonest = _repeats(own)
            letters = size * (1 - float(shares[i, 6]))
            yield [
                math.log1p(size),
                math.log1p(len(own)),
                *shares[i].tolist(),
                letters / max(1, len(own)),
                float(longest[i]),
                distinct,
                commonest,
                float((own[1:] == own[:-1]).mean()) if len(own) > 1 else 0.0,
                math.log1p(len(own_lines)),
                _repeats(own_lines)[0],
                size / max(1, len(own_lines)),
            ]
            w0, l0 = w1, l1


def _longest_words(data: np.ndarray, offsets: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n)
    if len(rows) == 0:
        return out
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = np.zeros(len(data), bool)
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    before = np.r_[False, inside[:-1]]
    starts = np.flatnonzero(inside & (~before | first))
    sizes = np.add.reduceat(inside.astype(np.int64), starts)
    np.maximum.at(out, rows, sizes)
    return out


def statistics_of(text_col: str) -> Column:
    """A struct of the statistics of a text. Only texts go to Python, only numbers come back."""

    @F.arrow_udf("struct<" + ", ".join(f"{s}: double" for s in STATISTICS) + ">")
    def found(text: pa.Array) -> pa.Array:
        rows = np.array(list(text_statistics(text))).reshape(-1, len(STATISTICS))
        free_memory()
        return pa.StructArray.from_arrays([pa.array(c) for c in np.ascontiguousarray(rows.T)], STATISTICS)

    return found(F.col(text_col).cast("string"))


# -- rules --------------------------------------------------------------------------------


# Rows of the fit that are worth a task of their own, in each of its hundreds of short jobs.
TASK_ROWS = 25_000


class Rule(NamedTuple):
    """Conditions low < statistic <= high, joined; by name of the statistic."""

    conditions: tuple[tuple[str, float, float], ...]

    def column(self, prefix: str = "") -> Column:
        out = F.lit(True)
        for name, low, high in self.conditions:
            if low > -math.inf:
                out = out & (F.col(prefix + name) > low)
            if high < math.inf:
                out = out & (F.col(prefix + name) <= high)
        return out


def rule_flags(rules: list[Rule]) -> Column:
    """One byte per rule over rows with the statistics: 1 where it holds.

    The rules are the task's own data. All rules of a forest as one column expression take
    about 100 MB of the driver while they are planned.
    """
    place = {name: k for k, name in enumerate(STATISTICS)}
    cuts = [[(place[name], low, high) for name, low, high in rule.conditions] for rule in rules]

    @F.arrow_udf("array<tinyint>")
    def found(statistics: pa.Array) -> pa.Array:
        columns = [c.to_numpy(zero_copy_only=False) for c in statistics.flatten()]
        flags = np.ones((len(statistics), len(cuts)), np.int8)
        for j, conditions in enumerate(cuts):
            for k, low, high in conditions:
                # NaN is above all cuts, as it is for Spark and in the score's column.
                if low > -math.inf:
                    flags[:, j] &= ~(columns[k] <= low)
                if high < math.inf:
                    flags[:, j] &= columns[k] <= high
        ends = np.arange(len(statistics) + 1, dtype=np.int32) * np.int32(len(cuts))
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flags.ravel()))

    return found(F.struct(*STATISTICS))


class Ensemble(NamedTuple):
    """Rules with weights; ``score`` is the column of the probability."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, prefix: str = "") -> Column:
        margin = F.lit(self.intercept)
        for rule, weight in self.rules:
            margin = margin + F.when(rule.column(prefix), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-margin))


class Training(NamedTuple):
    """Sizes of the fit. ``rows`` bounds the labelled rows: of more, about so many are
    taken by a hash of their id.
    """

    rows: int = 20_000
    trees: int = 20
    depth: int = 4
    penalty: float = 0.0005
    seed: int = 7


def tree_rules(nodes: DataFrame, names: tuple[str, ...]) -> list[Rule]:
    """The distinct rules of a forest's node table, one for every node but the roots."""
    trees: dict[int, dict[int, object]] = {}
    for row in nodes.collect():  # trees * 2 ** (depth + 1) rows at most
        trees.setdefault(row["tree"], {})[row["id"]] = row
    found: dict[Rule, None] = {}
    for _, tree in sorted(trees.items()):
        todo = [(0, {})]
        while todo:
            at, box = todo.pop()
            node = tree[at]
            if box:
                found[Rule(tuple((n, *box[n]) for n in sorted(box)))] = None
            if node["left"] < 0:
                continue
            name, cut = names[node["feature"]], float(node["threshold"])
            low, high = box.get(name, (-math.inf, math.inf))
            todo.append((node["left"], box | {name: (low, min(high, cut))}))
            todo.append((node["right"], box | {name: (max(low, cut), high)}))
    return list(found)


def fit_rules(rows: DataFrame, training: Training = Training()) -> Ensemble:
    """Fit on rows with the statistics and ``label`` (0.0 or 1.0).

    Without rows, or with one class only, the ensemble is the smoothed share of label 1.
    """
    rows = cut_lineage(rows.select("label", *STATISTICS))
    good, n = rows.agg(F.sum("label"), F.count("*")).first()
    good = good or 0.0
    if good == 0 or good == n:
        return Ensemble(math.log((good + 1) / (n - good + 1)), ())
    assembled = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(rows)
    forest = RandomForestClassifier(
        numTrees=training.trees,
        maxDepth=training.depth,
        featureSubsetStrategy="onethird",
        minInstancesPerNode=5,
        seed=training.seed,
    ).fit(assembled)
    rules = tree_rules(node_table(forest), STATISTICS)
    if not rules:
        return Ensemble(math.log((good + 1) / (n - good + 1)), ())
    flags = rule_flags(rules).cast("array<double>")
    vectors = cut_lineage(rows.select("label", array_to_vector(flags).alias("features")))
    # Every evaluation of the loss is a job. In few tasks it is one stage, and the driver makes
    # one copy of the task for all executors instead of one per level of the sum.
    lasso = LogisticRegression(
        elasticNetParam=1.0, regParam=training.penalty, maxIter=100, standardization=False
    ).fit(vectors.coalesce(math.ceil(n / TASK_ROWS)))
    weights = [(r, float(w)) for r, w in zip(rules, lasso.coefficients) if w != 0.0]
    return Ensemble(float(lasso.intercept), tuple(weights))


def held_out(id_col: Column) -> Column:
    """Rows that are never learnt from: a fifth, by checksum of the id as text."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _fit(
    statistics: DataFrame, labels: DataFrame, label_id: str, label_col: str, training: Training
) -> Ensemble:
    """Fit on the rows (id, statistics) that have a label and are not held out."""
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(label_id).alias("id"))
    known = known.agg(F.max(label_col).cast("double").alias("label")).where(~held_out(F.col("id")))
    examples = cut_lineage(statistics.join(known, "id").dropDuplicates(["id"]))
    n = examples.count()
    if n > training.rows:
        share = F.pmod(F.xxhash64(F.col("id"), F.lit(training.seed)), F.lit(1_000_000))
        examples = examples.where(share < int(1_000_000 * training.rows / n))
    return fit_rules(examples, training)


def _statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id`` and the statistics of every row, written."""
    rows = bounded_batches(docs).select(F.col(id_col).alias("id"), statistics_of(text_col).alias("s"))
    return cut_lineage(rows.select("id", "s.*"))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
    label_col: str = "quality",
    threshold: float = 0.3,
    training: Training = Training(),
) -> DataFrame:
    """Per row of ``docs``: id, ``held_out``, ``score`` and ``predicted``.

    ``held_out`` rows (a null id too) are never learnt from; ``score`` is the probability
    of label 1, ``predicted`` 1 from ``threshold`` on. Null and empty texts have the
    statistics of the empty text and are scored like any other. Null labels count for
    nothing; of several labels of an id the largest counts. Repeated rows are scored each
    and learnt from once per id. Without labels of both classes all scores are equal. An
    empty table gives no rows; no other columns are read.
    """
    rows = _statistics(docs, id_col, text_col)
    score = _fit(rows, labels, label_id, label_col, training).score()
    return rows.select(
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        score.alias("score"),
        (score >= threshold).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
    label_col: str = "quality",
    threshold: float = 0.3,
    training: Training = Training(),
) -> DataFrame:
    """The rows of ``docs`` that are scored ``threshold`` or better, unchanged.

    Rows are scored as by ``quality_scores``: null and empty texts, null ids and repeated
    rows too. Columns may have any names; an empty table gives no rows. Texts are read twice,
    for the fit and to score every row where it is, and never shuffled: meeting their scores
    by id would send them all over the network.
    """
    ensemble = _fit(_statistics(docs, id_col, text_col), labels, label_id, label_col, training)
    name = free_name(docs, "_statistics")
    scored = docs.withColumn(name, statistics_of(text_col))
    return scored.where(ensemble.score(f"{name}.") >= threshold).select(*named(docs))
