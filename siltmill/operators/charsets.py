"""The text and charset of raw files: the likelier of UTF-8, where the bytes are valid, and some single-byte encodings.

Nothing is labelled: the files that are valid UTF-8 say which characters beyond ASCII stand between which others and near
which words. All encodings agree on ASCII, so a file is judged by its other characters alone, each in its distinct
contexts, so that a repeated line says no more than one. Valid UTF-8 is taken for something else only where its
characters are next to unknown to all other files and another encoding gives ones that fit. Byte pairs (pair_counts, pair_scores,
likeliest) are the lighter and less certain way to choose among single-byte encodings; with_texts goes by contexts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UTF_8 = "utf-8"
#: Tried beside UTF-8; the first of equally likely ones is taken.
ENCODINGS = ("cp1252", "cp850", "mac_roman", "hp_roman8")
#: Added to each count; one would drown what small corpora say in 65,536 pairs never seen.
ADDED = 0.01
#: Characters that share what is ADDED.
CHARACTERS = 1000
#: What a wider context must have been seen to weigh as much as the narrower one, and what a word must.
SEEN, SEEN_WORD = 2, 20
#: Log probability that a character is none of ASCII; an encoding that needs more of them has to explain each.
BEYOND_ASCII = -4
#: By how much another encoding must be likelier than valid UTF-8, as a log probability.
AHEAD = 10
#: Contexts are counted in so many cells, found by hashing; what shares a cell is counted as one.
CELLS = 1 << 21
#: Characters read at once in a task, more only if one file has more.
READ = 200_000
_PAIRS = 1 << 16


def encoded(text: Column, encoding: str) -> Column:
    """text in a single-byte encoding that agrees with ASCII, without Python: each character becomes the Latin-1 character of
    its byte. A character without a code fails."""
    codes = {bytes([i]).decode(encoding, "ignore"): chr(i) for i in range(255, 127, -1)}
    none = {chr(i): "\uffff" for i in range(128, 256)}  # which Latin-1 lacks
    moved = {x: y for x, y in (none | codes).items() if x and x != y}
    return F.encode(F.translate(text, "".join(moved), "".join(moved.values())), "ISO-8859-1")


def _pairs(raw: bytes) -> np.ndarray:
    """Which byte pairs follow each other in raw and at its ends, where a line feed stands for what is beyond."""
    codes = np.frombuffer(b"\n" + raw + b"\n", np.uint8).astype(np.uint16)
    return (codes[:-1] << 8) | codes[1:]


def _legible(raw: Column) -> Column:
    return F.is_valid_utf8(raw.cast("string"))


def _binary(raw: Column) -> Column:
    return F.contains(raw, F.lit(bytearray(b"\0")))


def pair_counts(texts: DataFrame, text_col: str, encodings: Sequence[str] = ENCODINGS) -> DataFrame:
    """encoding, pair (first byte times 256 plus second), n over all whole texts, characters without a code left out.
    Null texts count nothing. A task adds up what it reads, so at most 65,536 rows an encoding leave it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((len(encodings), _PAIRS), np.int64)
        for batch in batches:
            for text in batch.column(0):  # one at a time, so that a batch is held once
                for row, name in zip(seen, encodings if text.is_valid else (), strict=text.is_valid):
                    row += np.bincount(_pairs(text.as_py().encode(name, "ignore")), minlength=_PAIRS)
        which, pair = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array([encodings[i] for i in which], pa.string()), pa.array(pair, pa.int32()), pa.array(seen[which, pair])], ["encoding", "pair", "n"])

    parts = texts.select(text_col).mapInArrow(count, "encoding string, pair int, n long")
    return parts.groupBy("encoding", "pair").agg(F.sum("n").alias("n"))


def pair_scores(counts: DataFrame, encodings: Sequence[str] = ENCODINGS) -> np.ndarray:
    """Log probability of each byte pair (rows) in each encoding (columns), ADDED added to every count. What the driver
    gets is at most 65,536 counts an encoding, whatever the input."""
    found = counts.toArrow()
    seen = np.full((_PAIRS, len(encodings)), ADDED)
    names = {name: i for i, name in enumerate(encodings)}
    np.add.at(seen, (found["pair"].to_numpy(), [names[x] for x in found["encoding"].to_pylist()]), found["n"].to_numpy())
    return np.log(seen / seen.sum(axis=0))


def _decoded(raw: bytes, name: str) -> str | None:
    try:
        return raw.decode(name)
    except UnicodeDecodeError:
        return None


def likeliest(raw: bytes, scores: np.ndarray, encodings: Sequence[str] = ENCODINGS) -> tuple[str | None, str | None]:
    """Text and encoding of bytes that are no UTF-8; two nulls if no encoding decodes them."""
    pairs, n = np.unique(_pairs(raw), return_counts=True)
    for i in np.argsort(-(n @ scores[pairs]), kind="stable"):
        text = _decoded(raw, encodings[i])
        if text is not None:
            return text, encodings[i]
    return None, None


@cache
def _shapes() -> np.ndarray:
    """Code to its lower case and to its kind, for codes up to 65,535, which stands for all beyond."""
    kinds = {"\n": 1, " ": 2, ".": 3, "!": 3, "?": 3, ":": 3}
    letters = list(map(chr, range(1 << 16)))
    low = [ord(x.lower()) if len(x.lower()) == 1 else ord(x) for x in letters]
    return np.array([low, [kinds.get(x) or (4 if x.isupper() else 5 if x.islower() else 6 if x.isalpha() else 7 if x.isdigit() else 0) for x in letters]], np.uint64)


@cache
def _table(encoding: str) -> np.ndarray:
    """Byte to its code in a single-byte encoding; 0 where it has none (a NUL is never read)."""
    return np.array([ord(_decoded(bytes([i]), encoding) or "\0") for i in range(256)], np.uint16)


def _codes(text: str) -> np.ndarray:
    return np.minimum(np.frombuffer(text.encode("utf-32-le"), np.uint32), 0xFFFF).astype(np.uint16)


def _hashed(*parts: np.ndarray | int) -> np.ndarray:
    got = np.zeros_like(parts[-1], np.uint64)
    for part in parts:
        got = (got ^ np.asarray(part).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        got ^= got >> np.uint64(29)
    return got


def _sites(texts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The characters beyond ASCII of some texts: number of the text, the character between two before and two after (five
    rows), and the nearest words of ASCII letters before and after it in that text (two rows; 0 if none). Each distinct five
    characters once a text, where they come first. Line feeds stand for what is beyond a text's ends."""
    ends = np.full(2, 10, np.uint16)
    joined = np.concatenate([ends, *(x for text in texts for x in (text, ends))])
    bounds = 2 + np.cumsum([len(text) + 2 for text in texts])
    at = np.flatnonzero(joined > 127)
    of = np.searchsorted(bounds, at, "right")
    around = np.stack([joined[at + k] for k in range(-2, 3)])
    first = np.sort(np.unique(_hashed(of, *around), return_index=True)[1])
    at, of, around = at[first], of[first], around[:, first]
    letter = (joined | 32) - np.uint16(97) < 26
    edges = np.flatnonzero(letter[1:] != letter[:-1]) + 1
    start, end = edges[::2], edges[1::2]
    whole = (end - start > 1) & (joined[start - 1] < 128) & (joined[end] < 128)
    start, end = start[whole], end[whole]
    word = np.concatenate([[0], _hashed(end - start, *(joined[i] | 32 for i in (start, start + 1, end - 2, end - 1))) | np.uint64(1), [0]]).astype(np.uint64)
    home = np.concatenate([[-1], np.searchsorted(bounds, start, "right"), [-1]])
    after = np.searchsorted(start, at) + 1
    return of, around, np.stack([np.where(home[i] == of, word[i], 0) for i in (after - 1, after)])


def _cells(around: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cells of what is counted about characters (a column each) in each context (a row each), and of the contexts."""
    low, kind = _shapes()[:, around]
    contexts = [(), (low[1], low[3]), (low[0], low[1], low[3], low[4]), (low[0], low[1]), (low[3], low[4]), (words[0],), (words[1],), (kind[1], kind[3]), (kind[0], kind[1], kind[3], kind[4])]
    which = (0, 1, 2, 3, 4, 5, 5, 6, 7)  # words before and after are counted alike
    told = [kind[2] if i > 5 else low[2] for i in which]
    joint = np.stack([_hashed(i, *context, x) for i, context, x in zip(which, contexts, told, strict=True)])
    alone = np.stack([_hashed(100 + i, *context, np.zeros_like(low[2])) for i, context in zip(which, contexts, strict=True)])
    return (joint % CELLS).astype(np.int32), (alone % CELLS).astype(np.int32)


def _runs(texts: pa.Array) -> Iterator[range]:
    """Numbers of the rows to be read at once."""
    start = size = 0
    for i, text in enumerate(texts):
        more = len(text.as_buffer()) if text.is_valid else 0
        if size and size + more > READ:
            yield range(start, i)
            start, size = i, 0
        size += more
    yield range(start, len(texts))


def context_counts(texts: DataFrame, text_col: str) -> DataFrame:
    """cell, n, code: how often whole texts hold a character beyond ASCII in a context, or the context, each distinct five
    characters once a text; code is the lower-case character whose widest context has the cell. Null texts count nothing.
    A task adds up what it reads, so at most CELLS rows leave it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, code = np.zeros(CELLS, np.int64), np.zeros(CELLS, np.int32)
        for batch in batches:
            column = batch.column(0)
            for rows in _runs(column):
                _, around, words = _sites([_codes(column[i].as_py()) for i in rows if column[i].is_valid])
                joint, context = _cells(around, words)
                np.add.at(seen, joint.ravel(), 1)
                np.add.at(seen, context.ravel(), 1)
                code[joint[2]] = _shapes()[0][around[2]]
        cell = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(seen[cell]), pa.array(code[cell])], ["cell", "n", "code"])

    parts = texts.select(text_col).mapInArrow(count, "cell int, n long, code int")
    return parts.groupBy("cell").agg(F.sum("n").alias("n"), F.max("code").alias("code"))


def contexts(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts by cell, and by lower-case character the number of its distinct contexts. The driver gets at most CELLS rows,
    whatever the input."""
    found = counts.toArrow()
    seen = np.zeros(CELLS, np.float32)
    seen[found["cell"].to_numpy()] = found["n"].to_numpy()
    codes = found["code"].to_numpy()
    return seen, np.bincount(codes[codes > 0], minlength=1 << 16).astype(float)


def _fit(around: np.ndarray, words: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """How well characters fit their contexts: the logarithm of a product of probabilities by what stands on both sides, on
    each side, by the kinds of characters around, and by the nearest words."""
    joint, context = _cells(around, words)
    n, of = seen[joint], seen[context]
    alone = (n[0] + ADDED) / (of[0] + ADDED * CHARACTERS)

    def within(wider: np.ndarray, i: int, weight: float = SEEN) -> np.ndarray:
        return (n[i] + weight * wider) / (of[i] + weight)

    near = (within(alone, 5, SEEN_WORD) + within(alone, 6, SEEN_WORD)) / 2 / alone
    kind = within((n[7] + 0.5) / (of[7] + 2), 8)
    return np.log(within(within(alone, 1), 2) * kind * near) + np.log(within(alone, 3) * within(alone, 4)) / 2


def _known(texts: Sequence[np.ndarray], distinct: np.ndarray) -> np.ndarray:
    """How likely the characters of each valid UTF-8 text are by the contexts that other files hold; what is in this text
    alone, or in copies of it, says nothing."""
    of, around, _ = _sites(texts)
    low = _shapes()[0][around[2]].astype(np.int64)
    _, which, own = np.unique(of * (1 << 16) + low, return_inverse=True, return_counts=True)
    others = np.maximum(distinct[low] - own[which], 0)
    return np.bincount(of, np.log((others + ADDED) / (distinct.sum() + ADDED * CHARACTERS)) + BEYOND_ASCII, len(texts))


def read(raws: Sequence[bytes], model: tuple[np.ndarray, np.ndarray], encodings: Sequence[str] = ENCODINGS) -> list[tuple[str | None, str | None]]:
    """Text and encoding of each of some bytes, none empty or ASCII; two nulls where no encoding decodes them."""
    seen, distinct = model
    of, around, words = _sites([np.frombuffer(raw, np.uint8).astype(np.uint16) for raw in raws])
    valid = [_decoded(raw, UTF_8) for raw in raws]
    scores = np.full((1 + len(encodings), len(raws)), -np.inf)
    legible = [i for i, text in enumerate(valid) if text is not None]
    if legible:
        scores[0, legible] = AHEAD + _known([_codes(valid[i]) for i in legible], distinct)
    for score, name in zip(scores[1:], encodings, strict=True):
        read_as = _table(name)[around]
        score[:] = np.bincount(of, _fit(read_as, words, seen) + BEYOND_ASCII, len(raws))
        score[of[(read_as == 0).any(axis=0)]] = -np.inf
    best = np.argmax(scores, axis=0)
    return [(None, None) if scores[k, i] == -np.inf else (valid[i], UTF_8) if k == 0 else (raws[i].decode(encodings[k - 1]), encodings[k - 1]) for i, k in enumerate(best)]


def with_texts(files: DataFrame, raw_col: str, text_col: str = "content", encoding_col: str = "src_encoding", encodings: Sequence[str] = ENCODINGS) -> DataFrame:
    """files without raw_col, with the whole text and its charset.

    encodings have one byte a character and agree with ASCII. Null bytes and bytes with a NUL (binary files) have neither
    text nor charset; bytes of ASCII, or none, are UTF-8. Where no file is valid UTF-8 all
    encodings are equally likely and the first that decodes is taken. Rows are decided one by one; a copy of a file lends
    it no support as UTF-8, and ids play no part. Languages that no UTF-8 file holds are not told apart well. text_col and
    encoding_col replace columns of these names; no table but the counts' is shuffled. ASCII is decided in the JVM, and
    only other bytes go to Python.
    """
    raw = F.col(raw_col)
    legible = _legible(raw) & ~_binary(raw)
    plain = legible & (F.length(raw.cast("string")) == F.octet_length(raw))
    known = files.filter(legible & ~plain).select(raw.cast("string").alias("text"))
    model = contexts(context_counts(known, "text"))

    @F.arrow_udf("text string, encoding string")
    def guess(raws: pa.Array) -> pa.Array:
        done = []
        for rows in _runs(raws):
            given = [raws[i].as_py() for i in rows if raws[i].is_valid]
            found = iter(read(given, model, encodings) if given else ())
            told = [next(found) if raws[i].is_valid else (None, None) for i in rows]
            done.append(pa.StructArray.from_arrays([pa.array([x[k] for x in told], pa.string()) for k in (0, 1)], ["text", "encoding"]))
        return pa.concat_arrays(done)

    opened = files.withColumn("__guess", guess(F.when(~plain & ~_binary(raw), raw)))
    told = {text_col: F.when(plain, raw.cast("string")).otherwise(F.col("__guess.text")), encoding_col: F.when(plain, F.lit(UTF_8)).otherwise(F.col("__guess.encoding"))}
    return opened.withColumns(told).drop("__guess", *({raw_col} - set(told)))
