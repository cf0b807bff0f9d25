"""Quality rules: a decision list learned by sequential covering.

Statistics of every whole text are taken in one pass.  From a bounded sample of
labelled rows a rule is grown (the threshold condition with the most FOIL gain
is added until no good row is covered), pruned on held-back rows (last
conditions are dropped while that helps) and accepted if it is precise there;
the rows it covers leave, and the next rule is learned.  The list becomes one
ordered Spark conditional expression over the statistics, and that judges all
documents.

Cases: null text has no word and fails the base rules; no labelled row, or no
bad one, gives an empty list, which keeps all that pass the base rules; labels
that are null or neither 0 nor 1, or name no document, are not used; a null
``doc_id`` is left out; repeated rows are judged alike, one result row each; an
empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.common import _SPACE, content_hashes, documents, grams, ids_of, record_batch, ship, smallest_hashes, steps, table, utf8, words

#: Labelled rows a list is learned from, at most: those with the smallest hashes of their ids.
SAMPLE_ROWS = 20_000
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_WINDOW = 8

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_FURTHER = ("n_distinct_words", "n_upper", "n_marks", "n_lines", "n_same_next")
_SCHEMA = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in COUNTS + _FURTHER]])
_DDL = ", ".join(f"{f.name} long" for f in _SCHEMA)


def _per(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.append(0, np.cumsum(mask, dtype=np.int64))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _distinct(owner: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((value, owner))
    o, v = owner[order], value[order]
    new = np.append(True, (o[1:] != o[:-1]) | (v[1:] != v[:-1])) if len(o) else np.zeros(0, bool)
    return np.bincount(o[new], minlength=n)


def statistics_of(column: pa.Array) -> list[np.ndarray]:
    """The counts of every text of a column."""
    data, offsets = utf8(column)
    n = len(offsets) - 1
    start, end, first = words(data, offsets)
    owner = ids_of(first)
    codes = content_hashes(data, start, end)
    chars = _per((data & 0xC0) != 0x80, offsets) - _per(_SPACE[data], offsets)

    # lines that hold a word and equal an earlier one
    breaks = np.flatnonzero(data == 10)
    line_start = np.union1d(offsets[:-1][np.diff(offsets) > 0], breaks + 1)
    line_start = line_start[line_start < len(data)]
    line_doc = np.searchsorted(offsets, line_start, "right") - 1
    line_end = np.minimum(np.append(line_start[1:], len(data)), offsets[line_doc + 1])
    line_end = line_end - (data[line_end - 1] == 10)
    held = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    line_doc, line_hash = line_doc[held], content_hashes(data, line_start[held], line_end[held])
    lines = np.bincount(line_doc, minlength=n)
    repeats = lines - _distinct(line_doc, line_hash, n)

    # words under eight-word windows that stand twice or more in the text
    cover = np.zeros(len(start) + 1, np.int64)
    window = grams(codes, _WINDOW)
    at = np.flatnonzero(owner[: len(window)] == owner[_WINDOW - 1 :][: len(window)]) if len(window) else np.zeros(0, np.int64)
    order = np.lexsort((window[at], owner[at]))
    o, v = owner[at][order], window[at][order]
    same = (o[1:] == o[:-1]) & (v[1:] == v[:-1])
    again = at[order][np.append(same, False) | np.append(False, same)] if len(o) else at
    np.add.at(cover, again, 1)
    np.add.at(cover, np.minimum(again + _WINDOW, len(start)), -1)
    repeated = _per(np.cumsum(cover[:-1]) > 0, first)

    same_next = np.append((codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1]), False) if len(codes) else np.zeros(0, bool)
    marks = np.isin(data, list(b"!?.,;:"))
    return [np.diff(first), chars, _per(_SYMBOLS[data], offsets), repeats, repeated, _distinct(owner, codes, n), _per(_UPPER[data], offsets), _per(marks, offsets), lines, _per(same_next, first)]


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, counts) of every document."""

    def run(batches):
        for batch in steps(batches):
            yield record_batch(_SCHEMA, batch.column(0), *statistics_of(batch.column(1)))

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null").mapInArrow(run, _DDL)


def _ratios() -> dict[str, tuple[str, str]]:
    """Features: a count over another, or (over nothing) the count."""
    return {
        "words": ("n_words", ""),
        "word_length": ("word_chars", "n_words"),
        "symbols": ("n_symbols", "n_words"),
        "duplicate_lines": ("n_dup_lines", "n_lines"),
        "repeated_words": ("n_repeat_words", "n_words"),
        "distinct_words": ("n_distinct_words", "n_words"),
        "upper": ("n_upper", "word_chars"),
        "marks": ("n_marks", "n_words"),
        "same_next": ("n_same_next", "n_words"),
    }


FEATURES = tuple(_ratios())


def feature(name: str) -> Column:
    top, below = _ratios()[name]
    value = F.col(top).cast("double")
    return value / F.greatest(F.col(below), F.lit(1)).cast("double") if below else value


@dataclass(frozen=True)
class Condition:
    feature: int
    above: bool  # value >= threshold, else value < threshold
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, self.feature]
        return v >= self.threshold if self.above else v < self.threshold

    def column(self) -> Column:
        v = feature(FEATURES[self.feature])
        return v >= F.lit(self.threshold) if self.above else v < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{FEATURES[self.feature]} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _best_condition(x: np.ndarray, bad: np.ndarray) -> tuple[float, Condition | None]:
    """The condition with the most FOIL gain over the rows still covered."""
    p0, n0 = int(bad.sum()), int((~bad).sum())
    base, best = np.log2(p0 / (p0 + n0)), (0.0, None)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v = x[order, f]
        cut = np.flatnonzero(v[1:] > v[:-1]) + 1  # rows before a cut are below its threshold
        if not len(cut):
            continue
        below_p = np.cumsum(bad[order])[cut - 1]
        below_n = cut - below_p
        middle = (v[cut] + v[cut - 1]) / 2
        for above, p, n in ((False, below_p, below_n), (True, p0 - below_p, n0 - below_n)):
            gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1e-9) / (p + n)) - base), 0)
            k = int(np.argmax(gain))
            if gain[k] > best[0] + 1e-9:
                best = (float(gain[k]), Condition(f, above, float(middle[k])))
    return best


def learn(x: np.ndarray, bad: np.ndarray, least_precision: float = 0.9, least_rows: int = 5, most_conditions: int = 6) -> list[Rule]:
    """An ordered list of rules that name bad rows."""
    rules: list[Rule] = []
    held = np.arange(len(x)) % 3 == 2  # rows for pruning
    left = np.ones(len(x), bool)
    while bad[left & ~held].sum() >= least_rows:
        rule: list[Condition] = []
        rows = np.flatnonzero(left & ~held)
        while len(rule) < most_conditions and not bad[rows].all():
            _, condition = _best_condition(x[rows], bad[rows])
            if condition is None:
                break
            rule.append(condition)
            rows = rows[condition.holds(x[rows])]
        check = np.flatnonzero(left & held)

        def worth(r: Rule) -> tuple[float, int]:
            hit = covers(r, x[check])
            p, n = int(bad[check][hit].sum()), int((~bad[check][hit]).sum())
            return (p - n) / (p + n) if p + n else -1.0, p

        best = tuple(rule)
        for size in range(len(rule) - 1, 0, -1):
            if worth(tuple(rule[:size])) > worth(best):
                best = tuple(rule[:size])
        hit = covers(best, x) & left
        value, seen = worth(best)
        if not best or (value + 1) / 2 < least_precision or bad[hit].mean() < least_precision or not seen:
            break
        rules.append(best)
        left &= ~hit
    return rules


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def verdict(rules: list[Rule]) -> Column:
    """The list as one conditional expression: true keeps."""
    out = None
    for rule in rules:
        condition = F.lit(True)
        for c in rule:
            condition = condition & c.column()
        out = F.when(condition, False) if out is None else out.when(condition, False)
    return F.lit(True) if out is None else out.otherwise(True)


def learned(stats: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The decision list from at most ``sample_rows`` labelled documents."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").filter("quality in (0, 1) and doc_id is not null")
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = stats.filter(~base_failed()).join(known, "doc_id").select("doc_id", "quality", *[feature(f).alias(f) for f in FEATURES]).dropDuplicates(["doc_id"])
    sample = smallest_hashes(table(rows, "labelled"), "doc_id", sample_rows).toPandas()
    if sample.empty:
        return []
    return learn(sample[list(FEATURES)].to_numpy(float), sample["quality"].to_numpy() == 0)


def judged(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per document: the counts, the base rules' verdict and whether it stays."""
    stats = table(statistics(docs), "statistics")
    rules = learned(stats, labels, sample_rows)
    failed = base_failed()
    return stats.select("doc_id", *COUNTS, failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"))


def filtered(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that stay, as they are."""
    gone = judged(docs, labels).filter("not kept").select(F.col("doc_id").alias("gone_doc")).distinct()
    return docs.join(gone, docs.doc_id.cast("long") == gone.gone_doc, "left_anti")


def op7_quality(spark, sf_dir):
    return judged(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
