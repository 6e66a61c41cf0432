"""Severity grades by cumulative-link ordinal regression over sparse word features."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, utf8, written

SCHEMA = "doc_id long, severity int, expected_severity double, p_toxic double, toxic boolean"

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: bytes) -> set[bytes]:
    """Distinct words: runs of letters (all bytes from 0x80 count as letters), ASCII case folded."""
    return set(text.translate(_FOLD).split())


@dataclass(frozen=True)
class TrainOptions:
    """``sample``: bound of labelled rows used for fitting; ``features``: words kept (by a two-class
    score on the sample, at least ``min_docs`` documents each, at most ``word_bytes`` long); ``penalty``: L1
    weight, over the root of the number of fitted rows; ``ridge``: L2 weight, over that number, of the second
    fit; of every ``holdout`` sampled rows one sets the decision limit and one is only measured; ``grades``: the
    least number of grades above 0; ``rising``: words are chosen among those that raise severity only (most words
    say nothing of it, so with few labels a negative weight is mostly chance)."""

    sample: int = 8000
    features: int = 1024
    min_docs: int = 5
    word_bytes: int = 64
    penalty: float = 0.04
    ridge: float = 0.1
    steps: int = 500
    holdout: int = 5
    grades: int = 2
    rising: bool = True


@dataclass
class OrdinalModel:
    """P(grade >= j) = sigmoid(score - cuts[j-1]); one weight per word for all thresholds, rising cuts.

    The chance of a grade is the difference of two neighbouring sigmoids.
    """

    weights: dict[bytes, float] = field(default_factory=dict)
    cuts: list[float] = field(default_factory=lambda: [4.0, 8.0])
    threshold: float = 0.5

    def score(self, text: bytes) -> float:
        known = self.weights
        return sum(known[w] for w in words_of(text) if w in known)

    def at_least(self, score: float) -> list[float]:
        import math

        return [1 / (1 + math.exp(-max(-500.0, min(500.0, score - c)))) for c in self.cuts]

    def dumps(self) -> str:
        return json.dumps({"weights": {w.hex(): x for w, x in self.weights.items()}, "cuts": self.cuts, "threshold": self.threshold})

    @staticmethod
    def loads(text: str) -> OrdinalModel:
        form = json.loads(text)
        return OrdinalModel({bytes.fromhex(w): x for w, x in form["weights"].items()}, form["cuts"], form["threshold"])


def _ordinal(margin, y, cuts):
    """Log-likelihood of grades ``y`` at scores ``margin`` and, per row, its derivatives in the sigmoid
    arguments above (``u``) and below (``l``): the chance of grade k is sigmoid(u) - sigmoid(l) with
    u = margin - cuts[k-1] and l = margin - cuts[k]; grade 0 has no u, the top grade no l."""
    import numpy as np

    top = len(cuts)
    has_u, has_l = y > 0, y < top
    u = np.where(has_u, margin - cuts[np.maximum(y - 1, 0)], 500.0)
    low = np.where(has_l, margin - cuts[np.minimum(y, top - 1)], -500.0)
    # sigmoid(u) - sigmoid(l) = sigmoid(u) * sigmoid(-l) * (1 - exp(l - u)), without cancellation
    log_p = -np.logaddexp(0, -u) - np.logaddexp(0, low) + np.log(-np.expm1(np.minimum(low - u, -1e-12)))
    su, sl = 1 / (1 + np.exp(-np.clip(u, -500, 500))), 1 / (1 + np.exp(-np.clip(low, -500, 500)))
    p = np.exp(np.maximum(log_p, -600))
    du, dl = np.where(has_u, su * (1 - su), 0.0), np.where(has_l, sl * (1 - sl), 0.0)
    fu, fl = du / p, -dl / p
    fuu, fll, ful = du * (1 - 2 * su) / p - fu * fu, -dl * (1 - 2 * sl) / p - fl * fl, -fu * fl
    return log_p, fu, fl, fuu, fll, ful


def fit(x, grades: list[int], options: TrainOptions = TrainOptions()):
    """(weights, cuts) of the cumulative-link model over the 0/1 table ``x``, by maximum likelihood.

    Words are chosen by proximal gradient steps with a soft threshold on their weights; weights and cuts
    are then fitted again on the chosen ones by damped Newton steps without that shrinkage.
    """
    import numpy as np

    y = np.array(grades, np.int64)
    top = max(options.grades, int(y.max()) if len(y) else 0)
    if not len(y) or (y > 0).all() or not (y > 0).any():
        return np.zeros(x.shape[1]), np.array([4.0 + 4 * j for j in range(top)])
    share = np.clip([(y >= j).mean() for j in range(1, top + 1)], 1e-4, 1 - 1e-4)
    base = np.maximum.accumulate(-np.log(share / (1 - share))) + 1e-2 * np.arange(top)
    n = len(y)

    def cut_slopes(fu, fl):
        """Slopes of the log-likelihood in the cuts."""
        out = np.zeros(top)
        np.add.at(out, np.maximum(y - 1, 0), -fu * (y > 0))
        np.add.at(out, np.minimum(y, top - 1), -fl * (y < top))
        return out

    w, cuts, look, t = np.zeros(x.shape[1], np.float32), base.copy(), np.zeros(x.shape[1], np.float32), 1.0
    step = 4.0 / (1 + max(1.0, float(x.sum(1).mean()))) / 2
    soft = options.penalty / n**0.5
    for _ in range(options.steps):
        _, fu, fl, *_ = _ordinal((x @ look).astype(float), y, cuts)
        moved = look + step * (x.T @ (fu + fl).astype(np.float32)) / n
        moved = np.maximum(moved - step * soft, 0) if options.rising else np.sign(moved) * np.maximum(np.abs(moved) - step * soft, 0)
        cuts = cuts + step * cut_slopes(fu, fl) / n
        cuts = np.maximum.accumulate(cuts - 1e-3 * np.arange(top)) + 1e-3 * np.arange(top)
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        look, w, t = moved + np.float32((t - 1) / after) * (moved - w), moved, after
    support = np.flatnonzero(w)
    small, p = x[:, support].astype(float), len(support)
    at = np.concatenate((w[support].astype(float), cuts))
    ridge = np.concatenate((np.full(p, options.ridge / n), np.full(top, options.ridge / n)))
    mid = np.concatenate((np.zeros(p), base))

    def loss(z) -> float:
        if (np.diff(z[p:]) <= 0).any():
            return float("inf")
        return float(-_ordinal(small @ z[:p], y, z[p:])[0].sum() / n + (ridge * (z - mid) ** 2).sum() / 2)

    now = loss(at)
    above, below = np.zeros((n, top)), np.zeros((n, top))
    above[np.flatnonzero(y > 0), y[y > 0] - 1] = -1
    below[np.flatnonzero(y < top), y[y < top]] = -1
    for _ in range(40):
        _, fu, fl, fuu, fll, ful = _ordinal(small @ at[:p], y, at[p:])
        slope = -np.concatenate((small.T @ (fu + fl), cut_slopes(fu, fl))) / n + ridge * (at - mid)
        curve = np.zeros((p + top, p + top))
        curve[:p, :p] = (small * (fuu + 2 * ful + fll)[:, None]).T @ small
        curve[:p, p:] = small.T @ (above * (fuu + ful)[:, None] + below * (fll + ful)[:, None])
        curve[p:, :p] = curve[:p, p:].T
        cross = (above * ful[:, None]).T @ below
        curve[p:, p:] = (above * fuu[:, None]).T @ above + (below * fll[:, None]).T @ below + cross + cross.T
        move = np.linalg.solve(-curve / n + np.diag(ridge + 1e-9), slope)
        length = 1.0
        while length > 1e-4 and not loss(at - length * move) <= now:
            length /= 2
        if length <= 1e-4:
            break
        at = at - length * move
        before, now = now, loss(at)
        if before - now < 1e-10:
            break
    weights = np.zeros(x.shape[1])
    weights[support] = at[:p]
    return weights, at[p:]


def grade_of(labels: DataFrame) -> Column:
    """Ordered grade of a label row: 0 not toxic, else ``toxic``, and one more where the text is of low quality as well."""
    toxic = F.col("toxic").cast("int")
    worse = F.when(F.col("quality") == 0, 1).otherwise(0) if "quality" in labels.columns else F.lit(0)
    return F.when(toxic > 0, toxic + worse).otherwise(0)


@dataclass
class Sample:
    """Labelled rows over chosen words: ``x`` is 0/1, ``grades`` and ``fold`` are per row."""

    words: list[bytes]
    x: object
    grades: list[int]
    fold: list[int]


def labelled_sample(docs: DataFrame, labels: DataFrame, options: TrainOptions) -> Sample:
    """At most ``options.sample`` labelled documents by hash of their id, as a table over the words with the
    best two-class scores on the rows that are fitted.

    Rows without a toxic label are left out; of several labels of an id the highest holds, of several texts the
    least. Texts and words stay on the executors; the driver gets ``features`` words of bounded length and
    one list of at most as many numbers per sampled row.
    """
    import numpy as np

    picked = (
        labels.filter("toxic is not null and doc_id is not null")
        .select(F.col("doc_id").cast("long").alias("id"), grade_of(labels).alias("grade"))
        .groupBy("id").agg(F.max("grade").alias("grade"))
        .orderBy(F.xxhash64(F.lit("severity"), "id"), "id")
        .limit(options.sample)
    )
    place = F.row_number().over(Window.orderBy(F.xxhash64(F.lit("severity"), "id"), "id"))  # a bounded table
    picked = written(picked.withColumn("fold", F.pmod(place - 1, F.lit(options.holdout))))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(F.broadcast(picked), "id")
    texts = texts.groupBy("id", "grade", "fold").agg(F.min("text").alias("text"))

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [[w for w in words_of(t) if len(w) <= options.word_bytes] for t in utf8(batch, "text")]
            arrays = [batch.column(i) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(found, pa.list_(pa.binary()))], names=["id", "grade", "fold", "words"])

    rows = written(texts.select("id", "grade", "fold", "text").mapInArrow(cut, "id long, grade int, fold int, words array<binary>"))
    fitted = rows.filter("fold > 1")
    positive, total = fitted.agg(F.count_if(F.col("grade") > 0), F.count(F.lit(1))).first()
    negative = max(1, total - positive)
    positive = max(1, positive)
    counts = fitted.select("grade", F.explode("words").alias("word")).groupBy("word").agg(F.count_if(F.col("grade") > 0).alias("a"), F.count_if(F.col("grade") == 0).alias("b"))
    mean = (F.col("a") + F.col("b")) / max(1, total)
    gain = F.abs(F.col("a") / positive - F.col("b") / negative) / F.sqrt(mean * (1 - mean) * (1 / positive + 1 / negative) + 1e-12)
    often = counts.filter(F.col("a") + F.col("b") >= options.min_docs).select("word", F.round(gain, 9).alias("gain"))
    words = [bytes(r["word"]) for r in often.orderBy(F.desc("gain"), "word").limit(options.features).collect()]
    chosen = docs.sparkSession.createDataFrame([(w, i) for i, w in enumerate(words)], "word binary, at int")
    held = rows.select("id", F.explode("words").alias("word")).join(F.broadcast(chosen), "word").groupBy("id").agg(F.sort_array(F.collect_list("at")).alias("at"))
    found = rows.select("id", "grade", "fold").join(held, "id", "left").orderBy("id").collect()
    forget(picked, rows)
    x = np.zeros((len(found), len(words)), np.float32)
    for i, r in enumerate(found):
        x[i, r["at"] or []] = 1
    return Sample(words, x, [r["grade"] for r in found], [r["fold"] for r in found])


def calibrated(chances: list[float], toxic: list[bool]) -> float:
    """The chance in [0.15, 0.5] from which on a text counts as toxic: best F1, ties to the highest."""
    best = (-1.0, 0.5)
    for i in range(15, 51):
        limit = i / 100
        caught = sum(flag for c, flag in zip(chances, toxic, strict=True) if c >= limit)
        wrong = sum(not flag for c, flag in zip(chances, toxic, strict=True) if c >= limit)
        f1 = 2 * caught / (caught + wrong + sum(toxic)) if caught else 0.0
        best = max(best, (round(f1, 9), limit))
    return best[1] if best[0] > 0 else 0.5


def train(docs: DataFrame, labels: DataFrame, options: TrainOptions = TrainOptions()) -> tuple[OrdinalModel, dict]:
    """Model and held-out figures: for toxic or not accuracy, recall and precision; for grades the share of exact
    ones and the mean distance of the expected severity, beside that of always saying the mean grade."""
    import numpy as np

    sample = labelled_sample(docs, labels, options)
    fold, grades = np.array(sample.fold, np.int64), np.array(sample.grades, np.int64)
    fitted = fold > 1
    weights, cuts = fit(sample.x[fitted], grades[fitted].tolist(), options)
    model = OrdinalModel({w: float(v) for w, v in zip(sample.words, weights, strict=True) if v}, [float(c) for c in cuts])
    reached = 1 / (1 + np.exp(-np.clip((sample.x @ weights)[:, None] - cuts, -500, 500)))
    model.threshold = calibrated(reached[fold == 1, 0].tolist(), (grades[fold == 1] > 0).tolist())
    test = fold == 0
    said, true = reached[test, 0] >= model.threshold, grades[test] > 0
    grade = (reached[test] >= np.array([model.threshold] + [0.5] * (len(cuts) - 1))).cumprod(1).sum(1)
    return model, {
        "train": int(fitted.sum()),
        "held_out": int(test.sum()),
        "accuracy": float((said == true).mean()) if test.any() else 0.0,
        "recall": float((said & true).sum() / max(1, true.sum())),
        "precision": float((said & true).sum() / max(1, said.sum())),
        "exact_grade": float((grade == grades[test]).mean()) if test.any() else 0.0,
        "distance": float(np.abs(reached[test].sum(1) - grades[test]).mean()) if test.any() else 0.0,
        "distance_of_mean": float(np.abs(grades[fitted].mean() - grades[test]).mean()) if test.any() and fitted.any() else 0.0,
    }


def severity(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """Expected severity and grade of every row of ``docs``.

    Null or empty text has no features and gets the model's base severity. Repeated rows and null ids
    are rows of their own; further columns are ignored. Narrow; the model holds at most ``features`` words.
    """
    form = docs.sparkSession.sparkContext.broadcast(model.dumps())

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = OrdinalModel.loads(form.value)
        for batch in batches:
            columns: list[list] = [[] for _ in range(4)]
            for text in utf8(batch, "text"):
                reached = own.at_least(own.score(text))
                grade = 0
                while grade < len(reached) and reached[grade] >= (0.5 if grade else own.threshold):
                    grade += 1
                for column, value in zip(columns, (grade, sum(reached), reached[0], grade > 0), strict=True):
                    column.append(value)
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            kinds = [pa.int32(), pa.float64(), pa.float64(), pa.bool_()]
            arrays = [ids, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "severity", "expected_severity", "p_toxic", "toxic"])

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(scan, SCHEMA)
