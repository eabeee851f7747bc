"""Quality classifier: document evidence combined with hierarchical empirical-Bayes rates of hosts and paths."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, quoted, store, without
from .shingles import pieces, word_values

# Bound of the labelled sample that the document classifier is fitted on, in rows.
SAMPLE = 8_000
# Weight of one unlabelled document's own evidence in its site's rate; a label counts 1.
SOFT = 0.5
THRESHOLD = 0.5
RIDGE = 1e-2

# Characters counted by the features: RE2 patterns.
COUNTED = {"upper": r"\p{Lu}", "symbol": r"[^\p{L}\p{N}\s.,;:'’()-]", "digit": r"\p{N}", "stop": r"[.,;]", "pipe": r"[|•]", "line": r"\n"}
NAMES = (*COUNTED, "words", "length", "distinct", "again", "spread")

OUTPUT = ("evidence", "host_rate", "path_rate", "score", "keep")


def features(texts: pa.Array) -> np.ndarray:
    """A row of numbers for each text: shares of characters, and how words vary and repeat; null is as empty."""
    texts = pa.concat_arrays([pc.fill_null(texts, "")])
    n = np.maximum(1, pc.utf8_length(texts).to_numpy(zero_copy_only=False)).astype(float)
    out = [np.log1p(100 * pc.count_substring_regex(texts, p).to_numpy(zero_copy_only=False) / n) for p in COUNTED.values()]
    words, counts = word_values(texts)
    row = np.repeat(np.arange(len(counts)), counts)
    some = np.maximum(1, counts)
    again = np.bincount(row[1:], weights=(words[1:] == words[:-1]) & (row[1:] == row[:-1]), minlength=len(counts)) if len(words) else np.zeros(len(counts))
    order = np.lexsort((words, row))
    w, r = words[order], row[order]
    first = np.ones(len(w), bool)
    first[1:] = (w[1:] != w[:-1]) | (r[1:] != r[:-1])
    distinct = np.bincount(r[first], minlength=len(counts))
    out += [np.log1p(counts), n / some / 10, np.log(np.maximum(1, distinct)) / np.log(some + 1.0), np.log1p(100 * again / some), distinct / some]
    return np.column_stack(out) if len(counts) else np.zeros((0, len(NAMES)))


class Classifier:
    """Ridge logistic regression on standardised features, their squares beside them."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, prior: float):
        self.mean, self.scale, self.weights, self.prior = mean, scale, weights, prior

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> Classifier:
        """Newton steps; with one class only, or no rows, the evidence is nought everywhere."""
        prior = (float(y.sum()) + 1) / (len(y) + 2)
        if len(set(y.tolist())) < 2:
            return cls(np.zeros(len(NAMES)), np.ones(len(NAMES)), np.zeros(2 * len(NAMES) + 1), prior)
        mean, scale = x.mean(0), x.std(0) + 1e-6
        model = cls(mean, scale, np.zeros(2 * len(NAMES) + 1), prior)
        z = model.inputs(x)
        penalty = RIDGE * len(y) * np.eye(z.shape[1])
        penalty[0, 0] = 0
        model.weights[0] = np.log(prior / (1 - prior))
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(z @ model.weights, -30, 30)))
            step = np.linalg.solve((z.T * (p * (1 - p) + 1e-9)) @ z + penalty, z.T @ (y - p) - penalty @ model.weights)
            model.weights += step
            if np.abs(step).max() < 1e-8:
                break
        return model

    def inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.column_stack([np.ones(len(z)), z, z * z / 4])

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """Log odds for good beyond the prior."""
        if not self.weights.any():
            return np.zeros(len(x))
        return np.clip(self.inputs(x) @ self.weights - np.log(self.prior / (1 - self.prior)), -30, 30)


def with_evidence(docs: DataFrame, model: Classifier) -> DataFrame:
    """``docs`` with the classifier's ``__llr``; null for texts without words."""
    parts = (model.mean, model.scale, model.weights, model.prior)
    names = docs.columns
    at = next(i for i, c in enumerate(names) if c.lower() == "text")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Classifier(*parts)
        for batch in batches:
            for piece in pieces(batch, at):
                x = features(piece.column(at))
                blank = x[:, NAMES.index("words")] == 0
                llr = pa.array(m.evidence(x), pa.float64(), mask=blank)
                yield pa.RecordBatch.from_arrays([*piece.columns, llr], names=[*names, "__llr"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    return docs.select(*quoted(names)).mapInArrow(judge, ", ".join([*fields, "__llr double"]))


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Classifier:
    """The document classifier, from about ``sample`` labelled documents drawn by a hash of their id."""
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").select(F.col("doc_id").alias("__id"), "quality")
    n = known.count()
    drawn = known.filter(F.pmod(F.xxhash64("__id"), F.lit(max(1, n))) < sample)
    rows = docs.join(F.broadcast(drawn), F.col("doc_id") == F.col("__id")).select("quality", "text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 1):
                x = features(piece.column(1))
                yield pa.RecordBatch.from_pydict({"y": piece.column(0).cast(pa.float64()), "x": pa.array(list(x), pa.list_(pa.float64()))})

    got = rows.mapInArrow(measure, "y double, x array<double>").collect()
    x = np.array([r["x"] for r in got]).reshape(-1, len(NAMES))
    return Classifier.fit(x, (np.array([r["y"] for r in got]) > 0).astype(float))


def _strength(rate: Column, n: Column, prior: Column) -> Column:
    """How many documents a level's prior is worth: moments of the rates below it.

    The spread of the rates beyond what counting gives, compared with that of one document.
    """
    one = F.avg(prior * (1 - prior))
    beyond = F.sum(n * (rate - prior) * (rate - prior)) / F.sum(n) - F.sum(prior * (1 - prior)) / F.sum(n)
    return F.greatest(F.lit(1.0), F.least(F.lit(1e6), one / F.greatest(beyond, F.lit(1e-9)) - 1))


def host_of(source: Column) -> Column:
    """Host of a source: a URL's authority, or the part before the first slash."""
    return F.lower(F.regexp_extract(F.coalesce(source, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)", 1))


def path_of(source: Column, lang: Column) -> Column:
    """First segment of a source's path; where it has none, the language, which sites use as that segment."""
    segment = F.regexp_extract(F.coalesce(source, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]*/([^/?#]*)", 1)
    return F.when(segment != "", segment).otherwise(F.coalesce(lang, F.lit("")))


def known_labels(labels: DataFrame) -> DataFrame:
    """``__id, __quality``: the largest label of each document that has one."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    return known.groupBy(F.col("doc_id").alias("__id")).agg(F.max("quality").alias("__quality"))


def own_part(model: Classifier) -> tuple[Column, Column]:
    """What a document counts in its path, and how much of that is good: its label, else SOFT of its probability."""
    prior = float(np.log(model.prior / (1 - model.prior)))
    p = F.coalesce(1 / (1 + F.exp(-(F.col("__llr") + prior))), F.lit(0.0))
    labelled = F.col("__quality").isNotNull()
    return F.when(labelled, F.lit(1.0)).otherwise(F.lit(SOFT)), F.when(labelled, (F.col("__quality") > 0).cast("double")).otherwise(SOFT * p)


def site_rates(judged: DataFrame, labels: DataFrame, model: Classifier) -> DataFrame:
    """``host, path`` with the shrunk rates of good documents, their counts and the strengths.

    ``judged`` has ``doc_id, host, path, __llr``.  A labelled document counts as its label, another as its classifier
    probability with weight SOFT.  Paths are sums of documents, hosts sums of paths, the corpus the sum of
    hosts; each level's rate is drawn towards the one above by a strength that the spread below it gives.
    """
    rows = judged.join(known_labels(labels), F.col("doc_id") == F.col("__id"), "left")
    weight, good = own_part(model)
    paths = store(rows.groupBy("host", "path").agg(F.sum(weight).alias("n"), F.sum(good).alias("s")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    # one row: the corpus's rate, and how much a host draws on it
    all_ = paths.agg((F.sum("s") + 1) / (F.sum("n") + 2)).first()[0]
    all_ = 0.5 if all_ is None else float(all_)
    top = hosts.agg(_strength(F.col("hs") / F.col("hn"), F.col("hn"), F.lit(all_))).first()[0] or 1.0
    hosts = hosts.withColumn("host_rate", (F.col("hs") + top * all_) / (F.col("hn") + top))
    both = paths.join(hosts.withColumnRenamed("host", "__h"), F.col("host") == F.col("__h"))
    both = store(both.select("host", "path", "n", "s", "hn", "hs", "host_rate"), "rates")
    low = both.agg(_strength(F.col("s") / F.col("n"), F.col("n"), F.col("host_rate"))).first()[0] or 1.0
    strengths = {"strength": float(low), "host_strength": float(top), "corpus_rate": all_}
    return both.select("host", "path", "n", "s", "hn", "hs", "host_rate", *[F.lit(v).alias(k) for k, v in strengths.items()])


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """The columns of ``docs`` (or ``keep``) and ``OUTPUT``: the classifier's log odds, the rates of host and path, the posterior and the verdict.

    ``score`` is the probability that a document is good: its log odds plus those of its path's rate, from which (and from its host's) its own
    part is taken out, be it a label or a probability; so a label tells about other documents only (and teaches the classifier).  ``keep`` is ``score >= threshold``.

    A text that is null, empty or blank has score 0.  Null sources or languages make a site of their own.  Rows without doc_id,
    or with null quality, teach nothing; without labels of both kinds every document has nought as evidence.  Repeated
    rows get equal results; an empty table gives an empty table; columns of the input named as in ``OUTPUT`` are replaced.
    """
    docs = without(docs, *OUTPUT)
    columns = docs.columns if keep is None else keep
    model = fitted(docs, labels, sample)
    needed = docs.select(*quoted(list(dict.fromkeys([*columns, "doc_id", "source", "lang", "text"]))))
    site = {"__host": host_of(F.col("source")), "__path": path_of(F.col("source"), F.col("lang"))}
    own = F.col("doc_id").alias("__doc")
    judged = with_evidence(needed, model).withColumns(site).select(*quoted(columns), own, "__llr", "__host", "__path")
    if any(c.lower() == "text" for c in columns):
        # texts are judged twice rather than stored
        light = with_evidence(docs.select("doc_id", "source", "lang", "text"), model).withColumns(site)
        light = light.select("doc_id", F.col("__host").alias("host"), F.col("__path").alias("path"), "__llr")
    else:
        judged = store(judged, "judged")
        light = judged.select(F.col("__doc").alias("doc_id"), F.col("__host").alias("host"), F.col("__path").alias("path"), "__llr")
    rates = broadcast_if_small(store(site_rates(light, labels, model), "sites"))
    rates = rates.toDF(*[f"__{c}" for c in ("h", "p", "n", "s", "hn", "hs", "all_host_rate", "strength", "top", "corpus")])

    rows = judged.join(rates, (F.col("__host") == F.col("__h")) & (F.col("__path") == F.col("__p")))
    rows = rows.join(broadcast_if_small(store(known_labels(labels), "known")), F.col("__doc") == F.col("__id"), "left")
    weight, part = own_part(model)

    def without_own(n: str, good: str) -> tuple[Column, Column]:
        rest = F.greatest(F.col(n) - weight, F.lit(0.0))
        return rest, F.greatest(F.lit(0.0), F.least(F.col(good) - part, rest))

    others, good = without_own("__hn", "__hs")
    rows = rows.withColumn("__host_rate", (good + F.col("__top") * F.col("__corpus")) / (others + F.col("__top")))
    others, good = without_own("__n", "__s")
    rate = (good + F.col("__strength") * F.col("__host_rate")) / (others + F.col("__strength"))
    rate = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), rate))
    rows = rows.withColumn("__rate", rate)
    # a text without words has no evidence, and score 0
    odds = F.col("__llr") + F.log(F.col("__rate") / (1 - F.col("__rate")))
    score = F.coalesce(1 / (1 + F.exp(-odds)), F.lit(0.0))
    return rows.select(
        *quoted(columns),
        F.col("__llr").alias("evidence"),
        F.col("__host_rate").alias("host_rate"),
        F.coalesce("__rate", "__host_rate").alias("path_rate"),
        score.alias("score"),
        (score >= threshold).alias("keep"),
    )
