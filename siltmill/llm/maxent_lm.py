"""Language-model scores by a hashed maximum-entropy model with class-factored softmax.

    p(token | text before it) = p(class | features) * p(code | class, classes before) * p(token | code)

The most frequent tokens are codes of their own; every other token has the code of its ending, and within a code shares
its probability by smoothed counts, so the vocabulary may grow with the corpus while the model does not. Codes are
grouped into classes by the company they keep. Class weights belong to hashed features of the codes before (n-grams and
skips) and are trained by distributed gradient updates: each task takes adaptive steps over its texts, and per feature
the tasks' updates are averaged by how often they met it. Weights within a class come from counts over the whole corpus
by iterative scaling, one class per task. Texts are scored in numpy batches of many texts; counts of tokens that are too
many to broadcast are joined.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltmill.llm.tables import written

#: Tokens with a code of their own, endings for all others, and classes of both.
HEAD = 8192
ENDINGS = 1024
CLASSES = 48
CODES = HEAD + ENDINGS
#: Hashed features of what stands before a token.
DIMENSIONS = 1 << 15
#: Tokens whose counts are broadcast, the most frequent first; the rest are joined.
BROADCAST = 1 << 18
#: Rounds of training; each takes its own part of the texts, by a digest, so that all are learned from once.
ROUNDS = 2
STEP_TOKENS = 8192
RATE = 0.4
#: Tokens scored together.
BATCH_TOKENS = 1 << 15
#: Different tokens that a task counts before it passes them on.
HELD = 400_000
PRIOR = 0.1
SCALINGS = 12
#: No word holds white space.
END = b"\n"
_NEIGHBOURS = 64
_LAST = b".,;:!?)]}\"'"


def tokens_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words, then the end."""
    return [*(text or b"").lower().split(), END]  # of bytes: lower() changes A-Z only, split() splits at ASCII white space


def ending(token: bytes) -> int:
    """The code of a token that has none of its own: by its last bytes without punctuation."""
    return HEAD + zlib.crc32(token.rstrip(_LAST)[-3:]) % ENDINGS


def held_out(id_col: str) -> Column:
    """A tenth of the rows, by CRC-32 of the id; a null id is not one of them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 10 == 0, F.lit(False))


# --- counts ---


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    n: Counter = Counter()
    for batch in batches:
        for text in batch["text"]:
            n.update(tokens_of(text))
            if len(n) > HELD:
                yield pd.DataFrame({"token": list(n), "c": list(n.values())})
                n.clear()
    yield pd.DataFrame({"token": list(n), "c": list(n.values())})


def token_counts(texts: DataFrame) -> DataFrame:
    """token (binary), c of a column text (binary); counted within tasks before the shuffle."""
    return texts.select("text").mapInPandas(_counted, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


class Places(dict):
    """Token to its place in the arrays of Known; -1 for the others."""

    def __missing__(self, token: bytes) -> int:
        return -1


class Known:
    """The tokens whose counts are broadcast: their codes and counts, in their order; the end comes first."""

    def __init__(self, tokens: list[bytes], counts: list[int]):
        self.places = Places(zip([END, *tokens], range(len(tokens) + 1)))
        self.codes = np.array([0, *range(1, min(len(tokens) + 1, HEAD)), *map(ending, tokens[HEAD - 1 :])], np.int16)
        self.counts = np.array([*counts], np.int64)
        self.logs = np.log10(self.counts + PRIOR)


@dataclass
class Vocabulary:
    known: Known
    total: int
    distinct: int
    masses: np.ndarray  # by ending: smoothed counts of its tokens, and one unseen token's
    rest: bool  # whether there are tokens whose counts are joined

    @property
    def all_mass(self) -> float:
        return self.total + PRIOR * (self.distinct + 1)


def vocabulary(counts: DataFrame, broadcast: int = BROADCAST) -> Vocabulary:
    """Reads at most `broadcast` rows to the driver, whatever the number of tokens."""
    size = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("c"), F.lit(0))).first()
    rows = counts.filter(F.col("token") != F.lit(END)).orderBy(F.desc("c"), "token").limit(broadcast).toArrow()
    ends = counts.filter(F.col("token") == F.lit(END)).first()
    tokens = rows["token"].to_pylist()
    known = Known(tokens, [ends["c"] if ends else 0, *rows["c"].to_pylist()])
    code = F.pandas_udf(lambda tokens: tokens.map(ending), "int")(F.col("token"))
    whole = counts.select(code.alias("code"), "c").groupBy("code").agg(F.sum(F.col("c") + F.lit(PRIOR)).alias("m")).collect()
    masses = np.full(ENDINGS, PRIOR)
    for r in whole:
        masses[r["code"] - HEAD] += r["m"]
    for token, c in zip([END, *tokens][:HEAD], known.counts.tolist()):
        if c:
            masses[ending(token) - HEAD] -= c + PRIOR
    return Vocabulary(known, size[1], size[0], np.maximum(masses, PRIOR), size[0] > len(tokens) + 1)


# --- codes of texts ---

_ENCODED = "n_tokens long, n_known long, log_known double, log_shared double, codes binary, rest array<binary>, rest_n array<int>"


def _encode(text: bytes | None, known: Known) -> tuple:
    tokens = tokens_of(text)
    place = np.fromiter(map(known.places.__getitem__, tokens), np.int64, len(tokens))
    codes = known.codes[place]
    other = np.flatnonzero(place < 0)
    rest = Counter([tokens[i] for i in other.tolist()])
    if rest:
        own = {t: ending(t) for t in rest}
        codes[other] = [own[tokens[i]] for i in other.tolist()]
        place = place[place >= 0]
    logs = known.logs[place]
    return len(tokens), int(np.count_nonzero(known.counts[place])), float(logs.sum()), float(logs[known.codes[place] >= HEAD].sum()), codes.tobytes(), list(rest), list(rest.values())


def encoded(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """docs (uid, text) with _ENCODED: codes, sums over tokens whose counts are broadcast, and the other tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(words.known)

    def encode(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_encode(x, shared.value) for x in texts], columns=[x.split()[0] for x in _ENCODED.split(", ")])

    return docs.withColumn("e", F.pandas_udf(encode, _ENCODED)(F.col("text"))).select(*[c for c in docs.columns if c != "text"], "e.*")


def _grouped(batches: Iterator[pa.RecordBatch], tokens: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes, lengths) of many texts, about so many tokens at a time; a text is never split."""
    held, n = [], 0
    for batch in batches:
        for x in batch.column("codes"):
            held.append(np.frombuffer(x.as_buffer(), np.int16).astype(np.int64))
            n += len(held[-1])
            if n >= tokens:
                yield np.concatenate(held), np.array([len(h) for h in held])
                held, n = [], 0
    if held:
        yield np.concatenate(held), np.array([len(h) for h in held])


def _before(codes: np.ndarray, lengths: np.ndarray, back: int, edge: int) -> np.ndarray:
    """The code so many places before each token; edge where the text has none."""
    out = np.full(len(codes), edge, np.int64)
    out[back:] = codes[:-back]
    starts = np.cumsum(lengths) - lengths
    for i in range(back):
        out[(starts + i)[lengths > i]] = edge
    return out


def features(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows of hashed features: the last code, two skips, the last two codes, and the last with a skip."""
    one, two, three = (_before(codes, lengths, k, CODES) for k in (1, 2, 3))
    keys = (one, two, three, one * 16384 + two, one * 16384 + three)
    mixed = [(x.astype(np.uint64) + np.uint64((i + 1) << 40)) * np.uint64(0x9E3779B97F4A7C15) for i, x in enumerate(keys)]
    return np.stack([((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(49) for x in mixed]).astype(np.int32)


# --- classes ---


def _company(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CODES * 2 * _NEIGHBOURS, np.int64)
    for codes, lengths in _grouped(batches, 1 << 20):
        for side, near in ((0, _before(codes, lengths, 1, CODES)), (1, _before(codes[::-1], lengths[::-1], 1, CODES)[::-1])):
            total += np.bincount((codes * 2 + side) * _NEIGHBOURS + near * 40503 % 65521 % _NEIGHBOURS, minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])


def classes_of(company: np.ndarray, k: int = CLASSES, rounds: int = 15) -> np.ndarray:
    """A class for each row by k-means over the square roots of its neighbours' shares; rows never met are the last's."""
    x = np.sqrt(company / np.maximum(company.sum(axis=1, keepdims=True), 1))
    weight = np.log1p(company.sum(axis=1))
    rng = np.random.default_rng(7)
    centres = x[np.argsort(-weight, kind="stable")[:1]]
    for _ in range(k - 1):  # far ones first, by chance
        gap = weight * np.clip(2 - 2 * (x @ centres.T).max(axis=1), 1e-9, None)
        centres = np.vstack([centres, x[rng.choice(len(x), p=gap / gap.sum())]]) if gap.sum() else np.vstack([centres, x[:1]])
    for _ in range(rounds):
        of = (x @ centres.T - (centres * centres).sum(axis=1) / 2).argmax(axis=1)
        for c in range(k):
            mine = of == c
            if weight[mine].sum():
                centres[c] = np.average(x[mine], axis=0, weights=weight[mine])
    return np.where(weight > 0, of, k - 1).astype(np.int64)


# --- training ---


def _softmax(z: np.ndarray) -> np.ndarray:
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def logits(weights: np.ndarray, found: np.ndarray) -> np.ndarray:
    """By token: the sum of its features' rows and of the last row, the bias."""
    out = np.empty((found.shape[1], weights.shape[1]), weights.dtype)
    for i in range(0, len(out), 2048):  # what is added up stays in the processor's cache
        part = out[i : i + 2048]
        np.take(weights, found[0, i : i + 2048], axis=0, out=part, mode="clip")
        part += weights[-1]
        more = np.empty_like(part)
        for at in found[1:, i : i + 2048]:
            part += np.take(weights, at, axis=0, out=more, mode="clip")
    return out


def _by_feature(slope: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The features met, how often, and the sums of slope over their tokens; the bias, met by all, comes last.

    The first tokens of all features are added at once, then the second ones of those that have two, and so on; features
    of very many tokens are summed one by one.
    """
    flat = found.ravel().astype(np.uint16)  # which are sorted by radix
    order = np.argsort(flat, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], flat[order][1:] != flat[order][:-1]]))
    times, token = np.diff(np.append(edges, len(flat))), order % len(slope)
    out = np.empty((len(edges) + 1, slope.shape[1]), slope.dtype)
    np.take(slope, token[edges], axis=0, out=out[:-1], mode="clip")
    left, k = np.flatnonzero(times > 1), 1
    while len(left) > 64:
        out[left] += np.take(slope, token[edges[left] + k], axis=0)
        k += 1
        left = left[times[left] > k]
    for i in left:
        out[i] += slope[token[edges[i] + k : edges[i] + times[i]]].sum(axis=0)
    out[-1] = slope.sum(axis=0)
    return np.append(flat[order[edges]].astype(np.int64), DIMENSIONS), np.append(times, len(slope)), out


def train(weights: np.ndarray, batches: Iterator[tuple[np.ndarray, np.ndarray]], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Takes adaptive gradient steps on weights, in place; returns how often each feature was met and the new weights."""
    met, seen = np.zeros(len(weights), np.int64), np.ones(len(weights), np.float32)
    for codes, lengths in batches:
        found, target = features(codes, lengths), classes[codes]
        for first in range(0, len(codes), STEP_TOKENS):
            at, y = found[:, first : first + STEP_TOKENS], target[first : first + STEP_TOKENS]
            slope = _softmax(logits(weights, at))
            slope[np.arange(len(y)), y] -= 1
            rows, times, gradient = _by_feature(slope, at)
            seen[rows] += np.einsum("ij,ij->i", gradient, gradient)
            weights[rows] -= (RATE / np.sqrt(seen[rows]))[:, None] * gradient
            met[rows] += times
    return met, weights


def _update(known: DataFrame, weights: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """One round over known: the average of what the tasks changed, per feature by how often each met it."""
    width = weights.shape[1]
    shared = known.sparkSession.sparkContext.broadcast((weights, classes))

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old, of = shared.value
        met, new = train(old.copy(), _grouped(batches, STEP_TOKENS), of)
        rows = np.flatnonzero(met)
        change = ((new[rows] - old[rows]) * met[rows, None]).astype(np.float32)
        offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width)
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(met[rows]), pa.ListArray.from_arrays(offsets, pa.array(change.ravel()))], ["feature", "met", "change"])

    told = known.select("codes").mapInArrow(steps, "feature long, met long, change array<float>")
    sums = told.groupBy("feature").agg(F.sum("met").alias("met"), *[F.sum(F.get("change", F.lit(i))).alias(f"c{i}") for i in range(width)]).toArrow().to_pandas()
    new = weights.copy()
    new[sums["feature"]] += (sums[[f"c{i}" for i in range(width)]].to_numpy() / sums[["met"]].to_numpy()).astype(np.float32)
    return new


def _context_counts(classes: np.ndarray) -> callable:
    """Cells (part, class, first, second, n): part 0 a class after two classes, 1 and 2 a code after one of them."""
    edge = np.append(classes, CLASSES)
    wide = CLASSES + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.zeros(CLASSES * wide * wide, np.int64)
        codes_after = np.zeros((2, CODES * wide), np.int64)
        for codes, lengths in _grouped(batches, 1 << 18):
            one, two = (edge[_before(codes, lengths, k, CODES)] for k in (1, 2))
            whole += np.bincount((classes[codes] * wide + one) * wide + two, minlength=len(whole))
            for i, c in enumerate((one, two)):
                codes_after[i] += np.bincount(codes * wide + c, minlength=CODES * wide)
        at = np.flatnonzero(whole)
        cells = [(np.zeros(len(at), np.int64), at // wide**2, at // wide % wide, at % wide, whole[at])]
        for i in (0, 1):
            at = np.flatnonzero(codes_after[i])
            cells.append((np.full(len(at), i + 1), classes[at // wide], at // wide, at % wide, codes_after[i][at]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*cells)], ["part", "class", "first", "second", "n"])

    return count


def scaled(cells: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one class: its codes, weights by (class before, code) and (class before that, code), and the logarithms of the
    normalisers by both classes. Iterative scaling: each round moves weights by half the logarithm of what was observed
    over what is expected, smoothed by a count of one."""
    wide = CLASSES + 1
    codes = np.unique(cells.loc[cells["part"] == 1, "first"])
    seen = np.zeros((2, wide, len(codes)))
    for i in (0, 1):
        x = cells[cells["part"] == i + 1]
        seen[i, x["second"], np.searchsorted(codes, x["first"])] = x["n"]
    x = cells[cells["part"] == 0]
    one, two, n = x["first"].to_numpy(), x["second"].to_numpy(), x["n"].to_numpy(float)
    weights = np.zeros((2, wide, len(codes)))
    weights[0] = np.log(seen[0].sum(axis=0))  # as without context
    for _ in range(SCALINGS):
        expected = np.zeros_like(seen)
        for k in range(0, len(n), 256):
            a, b = one[k : k + 256], two[k : k + 256]
            p = _softmax(weights[0, a] + weights[1, b]) * n[k : k + 256, None]
            np.add.at(expected[0], a, p)
            np.add.at(expected[1], b, p)
        weights += np.log((seen + 1) / (expected + 1)) / 2
    norm = np.empty((wide, wide))
    for a in range(wide):
        z = weights[0, a] + weights[1]
        top = z.max(axis=1)
        norm[a] = top + np.log(np.exp(z - top[:, None]).sum(axis=1))
    return codes, weights[0], weights[1], norm


def _scaled_rows(cells: pd.DataFrame) -> pd.DataFrame:
    codes, first, second, norm = scaled(cells)
    blob = lambda x, kind: np.ascontiguousarray(x, kind).tobytes()
    return pd.DataFrame({"class": cells["class"].iloc[:1], "codes": [blob(codes, np.int64)], "first": [blob(first, np.float32)], "second": [blob(second, np.float32)], "norm": [blob(norm, np.float32)]})


@dataclass
class Model:
    """Its size is set by the parameters above, not by the corpus."""

    classes: np.ndarray
    weights: np.ndarray
    masses: np.ndarray
    first: np.ndarray = field(default_factory=lambda: np.zeros((CLASSES + 1, CODES), np.float32))
    second: np.ndarray = field(default_factory=lambda: np.zeros((CLASSES + 1, CODES), np.float32))
    norm: np.ndarray = field(default_factory=lambda: np.zeros((CLASSES, CLASSES + 1, CLASSES + 1), np.float32))

    def class_logs(self, found: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Natural logarithm of p(class | features) of the class named for each token."""
        out = np.empty(len(classes), np.float32)
        for i in range(0, len(out), 2048):
            z = logits(self.weights, found[:, i : i + 2048])
            top = z.max(axis=1)
            own = z[np.arange(len(z)), classes[i : i + 2048]] - top
            z -= top[:, None]
            np.exp(z, out=z)
            out[i : i + 2048] = own - np.log(z.sum(axis=1))
        return out

    def code_logs(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Natural logarithm of p(code | codes before) by token."""
        edge = np.append(self.classes, CLASSES)
        one, two = (edge[_before(codes, lengths, k, CODES)] for k in (1, 2))
        c = self.classes[codes]
        by_class = self.class_logs(features(codes, lengths), c).astype(float)
        return by_class + self.first[one, codes] + self.second[two, codes] - self.norm[c, one, two]

    def scores(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """log10 of each text's codes and, for codes of endings, over the ending's mass: the logarithm of a token's own
        smoothed count is still to be added."""
        each = self.code_logs(codes, lengths) / np.log(10)
        tail = codes >= HEAD
        each[tail] -= np.log10(self.masses)[codes[tail] - HEAD]
        return np.add.reduceat(each, np.cumsum(lengths) - lengths)


def fit(known: DataFrame, words: Vocabulary) -> Model:
    """Learns from all texts of known (uid, codes): a pass for the classes, one over ROUNDS parts for the class weights,
    one for the counts within classes."""
    company = np.zeros(CODES * 2 * _NEIGHBOURS)
    cells = known.select("codes").mapInArrow(_company, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    company[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    classes = classes_of(company.reshape(CODES, -1))
    model = Model(classes, np.zeros((DIMENSIONS + 1, CLASSES), np.float32), words.masses)
    of = np.bincount(classes, weights=company.reshape(CODES, 2, -1)[:, 0].sum(axis=1), minlength=CLASSES)
    none = np.bincount(classes, minlength=CLASSES) == 0
    model.weights[-1] = np.where(none, -60, np.log(of + 1))  # the bias begins as the classes' shares
    for r in range(ROUNDS):
        model.weights = _update(known.filter(F.pmod(F.xxhash64("uid"), F.lit(ROUNDS)) == r), model.weights, classes)
    counts = known.select("codes").mapInArrow(_context_counts(classes), "part long, class long, first long, second long, n long")
    sums = counts.groupBy("part", "class", "first", "second").agg(F.sum("n").alias("n"))
    taught = np.zeros(CODES, bool)
    for r in sums.groupBy("class").applyInPandas(_scaled_rows, "class long, codes binary, first binary, second binary, norm binary").collect():
        codes = np.frombuffer(r["codes"], np.int64)
        taught[codes] = True
        for table, of in ((model.first, r["first"]), (model.second, r["second"])):
            table[:, codes] = np.frombuffer(of, np.float32).reshape(CLASSES + 1, -1)
        model.norm[r["class"]] = np.frombuffer(r["norm"], np.float32).reshape(CLASSES + 1, -1)
    return _unmet(model, taught)


def _unmet(model: Model, taught: np.ndarray) -> Model:
    """Codes that no text taught get a class's smallest weight times e^-12 each; a class of such codes is shared evenly."""
    for c in np.unique(model.classes[~taught]):
        mine, others = ~taught & (model.classes == c), (taught & (model.classes == c)).any()
        least = float(model.norm[c].min()) - 12 if others else 0.0
        model.first[:, mine] = least
        model.norm[c] = np.logaddexp(model.norm[c], np.log(mine.sum()) + least) if others else np.log(mine.sum())
    return model


def _scored(model) -> callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [model.value.scores(*x) for x in _grouped(iter([batch]), BATCH_TOKENS)]
            yield pa.RecordBatch.from_arrays([batch.column("uid"), pa.array(np.concatenate([*parts, np.zeros(0)]))], ["uid", "m"])

    return score


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast: int = BROADCAST) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score (log10 by smoothed single tokens) and
    score (log10 by the model). Rows that are not held out are learned from, all of them.

    A null or empty text is the end alone. Repeated rows and ids give a row each; texts are scored whole, however long,
    and never split; without a row to learn from every token is unseen; an empty table gives no rows; other columns,
    whatever their names, are ignored. Unseen tokens of one ending count as one token.
    """
    spark = docs.sparkSession
    # tables that are read again; numbers given to rows hold once they are written
    rows = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("binary").alias("text"))
    counts = written(token_counts(rows.filter(~F.col("held_out"))), "token-counts")
    words = vocabulary(counts, broadcast)
    coded = written(encoded(rows, words).withColumn("uid", F.monotonically_increasing_id()), "coded-texts")
    model = spark.sparkContext.broadcast(fit(coded.filter(~F.col("held_out")).select("uid", "codes"), words))
    by_model = coded.select("uid", "codes").mapInArrow(_scored(model), "uid long, m double")
    sums = by_model.unionByName(_rest_sums(coded, counts, words), allowMissingColumns=True).groupBy("uid").agg(F.sum("m").alias("m"), F.coalesce(F.sum("logs"), F.lit(0.0)).alias("logs"), F.coalesce(F.sum("met"), F.lit(0)).alias("met"))
    out = coded.drop("codes", "rest", "rest_n").join(sums, "uid")
    base = F.col("log_known") + F.col("logs") - F.col("n_tokens") * F.lit(float(np.log10(words.all_mass)))
    score = F.col("m") + F.col("log_shared") + F.col("logs")
    return out.select(F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + F.col("met")).cast("long").alias("n_known"), F.lit(words.total).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"))


def _rest_sums(coded: DataFrame, counts: DataFrame, words: Vocabulary) -> DataFrame:
    """uid, logs, met: over the tokens whose counts are not broadcast. Each of these is rare, so none is a hot key."""
    pairs = coded.select("uid", F.explode(F.arrays_zip("rest", "rest_n")).alias("r")).select("uid", F.col("r.rest").alias("token"), F.col("r.rest_n").alias("k"))
    c = F.coalesce(F.col("c"), F.lit(0)) if words.rest else F.lit(0)
    met = pairs.join(counts, "token", "left") if words.rest else pairs
    each = met.select("uid", (F.col("k") * F.log10(c + F.lit(PRIOR))).alias("logs"), F.when(c > 0, F.col("k")).otherwise(0).cast("long").alias("met"))
    return each.groupBy("uid").agg(F.sum("logs").alias("logs"), F.sum("met").alias("met"))
