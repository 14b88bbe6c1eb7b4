"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. Raking scales the
cells' token weights in turn to the target token shares of each source, of each
language and of each topic, so that the weighted corpus has all three
marginals; a document is then sampled with a probability proportional to its
cell's weight, by a hash of its id.

Targets default to tempered shares: a value's token share to the power
``temper``, normalised. A sample holds about ``rate`` of all tokens: a cell's probability
is its weight times ``rate``, and weights are trimmed to ``1 / rate`` in every
round, so that no probability exceeds 1 and the untrimmed cells make up for the
trimmed ones. Cells without tokens keep weight 1.

Nulls of source, language or topic are a value of their own; a null or empty
text has no tokens and takes its cell's probability; a null id hashes as empty;
repeated rows are taken or left together. An empty table gives an empty result.
Other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh

ROUNDS = 25
TEMPER = 0.5
#: share of all tokens that a sample holds; weights go up to its inverse
RATE = 0.5
#: cells that the raking table may have; it is collected and broadcast
MAX_CELLS = 200_000
WORD = r"[^\x20\x09-\x0D]+"
DIGITS, RANGE = 13, float(1 << 52)


#: topic rules in order: (topic, condition on the text); the last takes the rest
TOPICS = [
    ("legal", lambda t: t.rlike("(?i)licen[sc]e|copyright")),
    ("contact", lambda t: F.contains(t, F.lit("@"))),
    ("tabular", lambda t: F.contains(t, F.lit(" | "))),
    ("longform", lambda t: F.length(t) > 8000),
    ("note", lambda t: F.length(t) < 600),
    ("prose", lambda t: F.lit(True)),
]


def topic_of(text: str = "text", rules=TOPICS) -> Column:
    """Topic of a text by the first rule that holds (null texts are empty)."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = F.lit(None).cast("string")
    for name, rule in reversed(rules):
        out = F.when(rule(t), F.lit(name)).otherwise(out)
    return out


@dataclass
class Mix:
    """Raked cells: ``(source, lang, topic, tokens, weight, probability)``, and for every
    value of a margin ``(margin, value, wanted share, reached share)``: weights are trimmed at
    1 / rate, so a value wanted above that multiple of its tokens stays below its target."""
    cells: list[tuple]
    margins: list[tuple] = field(default_factory=list)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.cells, "_s string, _l string, _t string, _n long, _w double, _p double")


def tempered(tokens: np.ndarray, value: np.ndarray, temper: float) -> np.ndarray:
    """Target tokens of each value of a margin."""
    n = np.bincount(value, tokens)
    t = np.where(n > 0, n ** temper, 0.0)
    return t / t.sum() * n.sum() if t.sum() else n


def rake(tokens: np.ndarray, margins: list[np.ndarray], targets: list[np.ndarray], rounds: int = ROUNDS,
         rate: float = RATE) -> np.ndarray:
    """Weight of each cell after ``rounds`` rounds over all margins."""
    w = np.ones(len(tokens))
    for _ in range(rounds):
        for value, target in zip(margins, targets):
            now = np.bincount(value, tokens * w, len(target))
            w = w * np.divide(target, now, out=np.ones(len(target)), where=now > 0)[value]
        w = np.minimum(w, 1 / rate)
    return w


def fit(docs: DataFrame, source: str = "source", lang: str = "lang", text: str = "text", topic: Column | None = None,
        temper: float = TEMPER, targets: dict[str, dict] | None = None, rounds: int = ROUNDS, rate: float = RATE,
        max_cells: int = MAX_CELLS) -> Mix:
    """Token counts of all documents by cell, raked to the targets.

    ``targets`` may give token shares by value for ``source``, ``lang`` or
    ``topic``; values it leaves out get none. The number of cells (sources x
    languages x topics, not documents) is checked against ``max_cells``.
    """
    t = topic if topic is not None else topic_of(text)
    cells = (docs.select(F.col(source).cast("string").alias("s"), F.col(lang).cast("string").alias("l"),
                         t.cast("string").alias("t"),
                         F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("n"))
             .groupBy("s", "l", "t").agg(F.sum("n").alias("n")))
    rows = cells.limit(max_cells + 1).collect()
    if len(rows) > max_cells:
        raise ValueError(f"more than {max_cells} cells of source, language and topic: use coarser sources")
    rows.sort(key=lambda r: tuple((x is None, x or "") for x in (r.s, r.l, r.t)))
    n = np.array([r.n for r in rows], float)
    margins, goals = [], []
    for name, key in (("source", "s"), ("lang", "l"), ("topic", "t")):
        values = {v: i for i, v in enumerate(dict.fromkeys(r[key] for r in rows))}
        m = np.array([values[r[key]] for r in rows], int)
        margins.append(m)
        given = (targets or {}).get(name)
        if given is None:
            goals.append(tempered(n, m, temper))
        else:
            share = np.array([float(given.get(v, 0.0)) for v in values])
            goals.append(share / (share.sum() or 1.0) * n.sum())
    w = rake(n, margins, goals, rounds, rate) if len(rows) else np.zeros(0)
    reached = []
    for name, m, goal, key in zip(("source", "lang", "topic"), margins, goals, ("s", "l", "t")):
        got = np.bincount(m, n * w, len(goal))
        for i, v in enumerate(dict.fromkeys(r[key] for r in rows)):
            reached.append((name, v, float(goal[i] / (goal.sum() or 1.0)), float(got[i] / (got.sum() or 1.0))))
    return Mix([(r.s, r.l, r.t, int(r.n), float(x), float(x * rate)) for r, x in zip(rows, w)], reached)


def _applied(docs: DataFrame, mix: Mix, id_col: str, source: str, lang: str, text: str, topic: Column | None,
             seed: str) -> tuple[DataFrame, list[str]]:
    """The rows of ``docs`` with four columns more, and the names of these."""
    t = topic if topic is not None else topic_of(text)
    named = fresh(docs, "_topic", "_weight", "_probability", "_selected", "_s", "_l", "_t", "_n", "_w", "_p")
    kind, weight, chance, chosen, s, g, k, n, w, p = named
    cells = F.broadcast(mix.frame(docs.sparkSession).toDF(s, g, k, n, w, p))    # at most max_cells rows
    d = docs.withColumn(kind, t.cast("string"))
    j = d.join(cells, F.col(f"`{source}`").cast("string").eqNullSafe(F.col(s))
               & F.col(f"`{lang}`").cast("string").eqNullSafe(F.col(g)) & F.col(kind).eqNullSafe(F.col(k)),
               "left")
    key = F.concat(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.lit(f"|{seed}"))
    u = (F.conv(F.substring(F.md5(key), 1, DIGITS), 16, 10).cast("double") + 0.5) / F.lit(RANGE)
    return j.select(*[F.col(f"`{c}`") for c in docs.columns], kind, F.col(w).alias(weight),
                    F.col(p).alias(chance), (u < F.col(p)).alias(chosen)), named[:4]


def apply(docs: DataFrame, mix: Mix, id_col: str = "doc_id", source: str = "source", lang: str = "lang",
          text: str = "text", topic: Column | None = None, seed: str = "mix") -> DataFrame:
    """The rows of ``docs`` with ``_topic``, ``_weight``, ``_probability`` and ``_selected``; a
    name that ``docs`` has already is lengthened by an underscore."""
    return _applied(docs, mix, id_col, source, lang, text, topic, seed)[0]


def sample(docs: DataFrame, **options) -> DataFrame:
    """The sampled rows of ``docs``, with their columns."""
    own = {k: options.get(k, k) for k in ("source", "lang", "text")}
    got, names = _applied(docs, fit(docs, **options), "doc_id", **own, topic=options.get("topic"), seed="mix")
    return got.filter(F.col(names[3])).select(*[F.col(f"`{c}`") for c in docs.columns])
