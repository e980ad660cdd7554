"""Quality rules: base statistics of whole texts, and a learned decision list over them.

Learning is sequential covering. From labelled rows' statistics it grows one conjunction of thresholds at a time for the
bad class (each literal is the threshold with the highest FOIL gain on a growing set), prunes its literals on a pruning
set, accepts it if it is precise enough there, removes what it covers, and goes on. The rules become one ordered Spark
conditional expression, so that the verdict of a document is a plain column expression over its statistics.

The labelled rows that train are at most ``train_rows`` (a documented bound), chosen by hash of the id. Statistics are
computed once, over all documents and whole texts, and staged; training and verdicts read the staged statistics.

Cases: null text has no words (and so fails the base rules); repeated rows of one id, in either table, train as that many rows
within the bound; null
labels do not train; without labelled rows of both classes the list is empty and the base rules alone decide; equal
statistics get equal verdicts; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import begin, docs_of, pick, slices, stage

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
LONGS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_chars", "n_upper", "n_digits", "n_distinct_words", "n_lines"]
TRAIN_ROWS = 20_000


def repeated_words(words: list[str], width: int = 5) -> int:
    """Words in windows of ``width`` words that the text holds twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    base = len(number)
    key = ids[:n].copy()
    for j in range(1, width):
        if int(key.max()) * base >= 2**62:  # keep the key exact
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
        key = key * base + ids[j : j + n]
    order = np.argsort(key, kind="stable")
    same = np.diff(key[order]) == 0
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(twice), 1)
    np.add.at(edge, np.flatnonzero(twice) + width, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def statistics_of(text: str) -> tuple[int, ...]:
    words = WORD.findall(text)
    lines = text.split("\n")
    seen: set[str] = set()
    dup = 0
    for line in lines:
        if line in seen:
            dup += 1
        elif line and WORD.search(line):
            seen.add(line)
    chars = sum(map(len, words))
    joined = "".join(words)
    upper = sum(map(str.isupper, joined)) if not joined.islower() else 0
    digits = sum(map(joined.count, "0123456789"))
    return len(words), chars, len(SYMBOL.findall(text)), dup, repeated_words(words), len(text), upper, digits, len(set(words)), len(lines)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, the base statistics, and further counts that rules may use."""
    names = ["doc_id", *LONGS, *MORE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("quality")
        for b in slices(batches):
            cols = list(zip(*map(statistics_of, b.column(1).to_pylist()), strict=True)) or [[]] * (len(names) - 1)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in cols)], names)

    return docs_of(docs, id_col, text_col).mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _ratio(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))




def features() -> dict[str, Column]:
    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word_chars": _ratio("word_chars", "n_words"),
        "symbols_per_word": _ratio("n_symbols", "n_words"),
        "dup_line_share": _ratio("n_dup_lines", "n_lines"),
        "repeat_word_share": _ratio("n_repeat_words", "n_words"),
        "upper_share": _ratio("n_upper", "word_chars"),
        "digit_share": _ratio("n_digits", "word_chars"),
        "distinct_word_share": _ratio("n_distinct_words", "n_words"),
        "words_per_line": _ratio("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Literal:
    feature: str
    at_least: bool
    threshold: float

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.threshold if self.at_least else x[self.feature] <= self.threshold

    def column(self, of: dict[str, Column]) -> Column:
        c = of[self.feature]
        return c >= F.lit(self.threshold) if self.at_least else c <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<='} {self.threshold:.6g}"


Rule = tuple[Literal, ...]


def _covered(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for lit in rule:
        out &= lit.covers(x)
    return out


def _best_literal(x: dict[str, np.ndarray], bad: np.ndarray, least: int) -> tuple[float, Literal | None]:
    p0, n0 = bad.sum(), len(bad)
    best: tuple[float, Literal | None] = (0.0, None)
    before = np.log2(max(p0, 1) / n0)
    for name in sorted(x):
        v = x[name]
        order = np.argsort(v, kind="stable")
        s, b = v[order], bad[order]
        up = np.cumsum(b)
        cut = np.flatnonzero(np.diff(s) > 0)
        for at_least in (False, True):
            p = up[cut] if not at_least else p0 - up[cut]
            n = cut + 1 if not at_least else n0 - cut - 1
            ok = n >= least
            if not ok.any():
                continue
            gain = np.where(ok & (p > 0), p * (np.log2(np.maximum(p, 1) / n) - before), 0)
            k = int(gain.argmax())
            if gain[k] > best[0] + 1e-9:
                best = (float(gain[k]), Literal(name, at_least, float((s[cut[k]] + s[cut[k] + 1]) / 2)))
    return best


def learn(x: dict[str, np.ndarray], bad: np.ndarray, least: int = 5, precision: float = 0.9, max_rules: int = 12, max_literals: int = 4, seed: int = 3) -> list[Rule]:
    """An ordered list of rules for the bad class."""
    rules: list[Rule] = []
    if not len(bad) or bad.all() or not bad.any():
        return rules
    prune = np.random.default_rng(seed).random(len(bad)) < 1 / 3
    alive = np.ones(len(bad), bool)
    while len(rules) < max_rules and (bad & alive & ~prune).sum() >= least:
        own, rule = alive & ~prune, ()
        while len(rule) < max_literals:  # grow
            k = np.flatnonzero(own)
            gain, lit = _best_literal({f: v[k] for f, v in x.items()}, bad[k], least)
            if lit is None:
                break
            rule += (lit,)
            own &= lit.covers(x)
            if bad[own].all():
                break
        if not rule:
            break

        def worth(r: Rule) -> float:
            c = _covered(r, x, len(bad)) & alive & prune
            p, n = (c & bad).sum(), (c & ~bad).sum()
            return (p - n) / max(1, p + n)

        while len(rule) > 1:  # prune final literals while that is no worse
            if worth(rule[:-1]) < worth(rule):
                break
            rule = rule[:-1]
        c = _covered(rule, x, len(bad)) & alive
        if bad[c].mean() < precision or ((c & prune).any() and bad[c & prune].mean() < precision):
            break
        rules.append(rule)
        alive &= ~c
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The ordered conditional expression: number of the first rule that covers the row, or -1."""
    of, out = features(), None
    for i, rule in enumerate(rules):
        test = rule[0].column(of)
        for lit in rule[1:]:
            test = test & lit.column(of)
        out = F.when(test, F.lit(i)) if out is None else out.when(test, F.lit(i))
    return F.lit(-1) if out is None else out.otherwise(F.lit(-1))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", label_id_col: str = "doc_id", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rule."""
    stats = stage(statistics(docs, id_col, text_col), "statistics")
    told = pick(labels, doc_id=label_id_col, label=label_col).filter("label is not null and doc_id is not null").select(F.col("doc_id").cast("long"), "label")
    some = told.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(train_rows)
    of = features()
    rows = stats.join(F.broadcast(some), "doc_id").filter(~base_failed()).select("doc_id", "label", *[c.alias(k) for k, c in of.items()])
    rows = rows.orderBy(F.xxhash64("doc_id"), *rows.columns).limit(train_rows).toPandas().sort_values(rows.columns, kind="stable")
    rules = learn({k: rows[k].to_numpy(float) for k in of}, (rows["label"] == 0).to_numpy())
    out = stats.withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return out.select("doc_id", *LONGS, "base_failed", (~F.col("base_failed") & (F.col("rule") < 0)).alias("kept"), "rule")
