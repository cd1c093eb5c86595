"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

The n-grams of a text's letters are hashed to DIMENSIONS features. Document frequencies cover every text that may be
learned from. The weights come from follow-the-regularised-leader with elastic-net penalties, fitted on a bounded
sample, and a temperature fitted on a part of the sample left out makes the scores probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 1 << 15
ORDERS = 3  # n-grams of one to so many characters
#: Rows that the weights and the temperature are fitted on, over all languages; the rest of the fit sees all rows.
MOST_ROWS = 4000
#: Labels beyond this many are not languages; fitting refuses them.
MOST_LANGUAGES = 500
#: Predictions under this score are rejected by understood().
LEAST_SCORE = 0.3
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.zeros((DIMENSIONS, 0)))  # by feature and language
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))
    temperature: float = 1.0

    def logits(self, found: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        at, x = weighed(found, self.idf)
        return x @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        found = ngrams(text)
        if not len(found[0]) or not self.languages:
            return UNKNOWN, 0.0
        p = softmax(self.logits(found) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """By code point: itself for letters, a space for the rest."""
    return np.array([i if chr(i).isalpha() else 32 for i in range(0x110000)], dtype=np.uint32)


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features of a whole text and their counts; both empty for a text without letters."""
    points = _letters()[np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), dtype=np.uint32)]
    points = np.concatenate([[np.uint32(32)], points, [np.uint32(32)]]).astype(np.uint32)
    inside = points != 32
    if not inside.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    points = points[np.concatenate([[True], inside[1:] | inside[:-1]])]  # one space between words
    h, total = np.zeros(len(points), np.uint32), np.zeros(DIMENSIONS, np.int64)
    for n in range(1, ORDERS + 1):
        h = h[: len(points) - n + 1] * np.uint32(0x01000193) + points[n - 1 :] * np.uint32(0x9E3779B1) + np.uint32(n)
        mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        total += np.bincount(mixed >> np.uint32(17), minlength=DIMENSIONS)
    at = np.flatnonzero(total)
    return at, total[at]


def weighed(found: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, n = found
    x = (1 + np.log(n)) * idf[at]
    return at, x / np.sqrt((x * x).sum())


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_weights(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_labels: int, rounds: int = 4, rate: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal: per weight, the running gradient z and squared gradients n; l1 leaves most weights at zero.

    The bias is a feature of its own without penalties.
    """
    z, n = np.zeros((DIMENSIONS + 1, n_labels)), np.zeros((DIMENSIONS + 1, n_labels))
    first, second = np.full(DIMENSIONS + 1, l1), np.full(DIMENSIONS + 1, l2)
    first[-1] = second[-1] = 0

    def weights(at: np.ndarray | slice) -> np.ndarray:
        pull = np.maximum(np.abs(z[at]) - first[at, None], 0) * np.sign(z[at])
        return -pull / ((beta + np.sqrt(n[at])) / rate + second[at, None])

    for turn in range(rounds):
        for i in np.random.default_rng(turn).permutation(len(rows)):
            at, x = np.append(rows[i][0], DIMENSIONS), np.append(rows[i][1], 1.0)
            w = weights(at)
            slope = softmax(x @ w)
            slope[labels[i]] -= 1
            g = x[:, None] * slope
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / rate * w
            n[at] = grown
    w = weights(slice(None))
    return w[:-1], w[-1]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, on a geometric grid that narrows.

    One row's worth of doubt is spread over the labels, so that a faultless sample does not claim certainty.
    """
    n, k = logits.shape
    doubt = 1 / (n + 2)
    target = np.full((n, k), doubt / k)
    target[np.arange(n), labels] += 1 - doubt
    low, high = 0.02, 20.0
    for _ in range(4):
        grid = np.geomspace(low, high, 25)
        loss = [-(target * np.log(softmax(logits / t) + 1e-300)).sum() for t in grid]
        best = int(np.argmin(loss))
        low, high = grid[max(best - 1, 0)], grid[min(best + 1, 24)]
    return float(grid[best])


def held_out(id_col: str) -> Column:
    """Rows that nothing is learned from to test on: a fifth, by CRC-32 of the id; a null id is not one of them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total, n = np.zeros(DIMENSIONS, np.int64), 0
    for batch in batches:
        for text in batch["text"]:
            at, _ = ngrams(text)
            total[at] += 1
            n += 1
    at = np.flatnonzero(total)
    yield pd.DataFrame({"feature": np.append(at, -1), "n": np.append(total[at], n)})


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [ngrams(x) for x in batch["text"]]
        yield pd.DataFrame({"lang": batch["lang"], "mark": batch["mark"], "at": [a.astype(np.int32) for a, _ in found], "n": [n.astype(np.int32) for _, n in found]})


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most_rows: int = MOST_ROWS) -> Model:
    """Learns from the text and label of rows that are not held out and have an id, a text and a label.

    Labels and document frequencies are counted over all of these. The sample is the rows of smallest digest, an
    equal number per language and most_rows in all; a fifth of it fits the temperature.
    """
    known = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & ~held_out(id_col))
    sizes = {r["lang"]: r["n"] for r in known.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} labels in {lang_col}")
    languages = sorted(sizes)
    seen = known.select(F.col(text_col).alias("text")).mapInPandas(_frequencies, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(DIMENSIONS)
    total = 0
    for r in seen:
        if r["feature"] < 0:
            total = r["n"]
        else:
            df[r["feature"]] = r["n"]
    model = Model(languages, np.log((1 + total) / (1 + df)) + 1)
    if not languages:
        return model
    each = max(2, most_rows // len(languages))
    mark = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 30))
    cut = F.element_at(F.create_map(*[F.lit(v) for x in languages for v in (x, int(min(1.0, 1.1 * each / sizes[x]) * (1 << 30)))]), F.col(lang_col))
    drawn = known.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), mark.alias("mark")).filter(F.col("mark") < F.when(F.col("lang").isNotNull(), cut))
    sample = drawn.mapInPandas(_counted, "lang string, mark long, at array<int>, n array<int>").toPandas().sort_values(["lang", "mark"])
    sample = sample[sample["at"].map(len) > 0].groupby("lang").head(each).reset_index(drop=True)
    if not len(sample):
        return model
    rows = [(np.asarray(a), np.asarray(n)) for a, n in zip(sample["at"], sample["n"])]
    labels = np.array([languages.index(x) for x in sample["lang"]])
    rest = np.arange(len(rows)) % 5 == 4
    learn = [weighed(rows[i], model.idf) for i in np.flatnonzero(~rest)]
    model.weights, model.bias = fit_weights(learn, labels[~rest], len(languages))
    if rest.any():
        model.temperature = fit_temperature(np.stack([model.logits(rows[i]) for i in np.flatnonzero(rest)]), labels[rest])
    return model


def predicted(docs: DataFrame, text_col: str, model: Model) -> Column:
    """struct<lang_pred string, score double> of a whole text; `und` and 0 if it is null or has no letter.

    The model is broadcast; its size is DIMENSIONS times the languages, whatever the input.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(x) for x in texts], columns=["lang_pred", "score"])

    return F.pandas_udf(predict, "lang_pred string, score double")(F.col(text_col))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """id, held_out, lang_pred, score of every row, by a model learned from docs.

    Without a row to learn from, all texts are `und`. Null and empty texts and those without a letter are `und` with
    score 0. A text is read whole, in memory that grows with it. Of equal scores the language first in order wins.
    Repeated rows give repeated rows; an empty table gives none; other columns are ignored.
    """
    model = fit(docs, id_col, text_col, lang_col)
    return docs.select(F.col(id_col), held_out(id_col).alias("held_out"), predicted(docs, text_col, model).alias("p")).select(id_col, "held_out", "p.*")


def understood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least_score: float = LEAST_SCORE) -> DataFrame:
    """docs without the rows of unknown language or of a score under least_score. Without a label to learn from, the
    rows whose text has a letter stay. Null texts go; repeated rows stay or go together; an empty table stays empty, and
    columns of any names but __p come through."""
    model = fit(docs, id_col, text_col, lang_col)
    if not model.languages:
        return docs.filter(F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    rated = docs.withColumn("__p", predicted(docs, text_col, model))
    return rated.filter((F.col("__p.lang_pred") != UNKNOWN) & (F.col("__p.score") >= least_score)).drop("__p")
