"""SentencePiece encoding and decoding with segmentations drawn without replacement.

A text's segmentations are the paths of a lattice whose edges are the vocabulary's pieces. Every path has a Gumbel
perturbation of its log-probability and the k largest are k draws without replacement. They are found by A-star
search: the bound of a node is the largest perturbed value below it, which is drawn top down, given its parent's. A
best path found, the nodes that leave it by another choice go on the agenda with their bounds; the agenda's best is
expanded next. So no path is drawn twice and none is rejected.

No piece of such a vocabulary goes on behind a word's end, so a text's lattice is a chain of its words' lattices, and
a node of the search is a choice of words so far. The words of a batch of texts are walked at once, each distinct
word's lattice built once a batch. All that is random is a hash of the row key, the draw and the place.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: The session's setting that names another vocabulary file.
MODEL_SETTING = "spark.siltmill.pieceModel"
SAMPLES = 2
#: Power of the pieces' probabilities: under 1 for flatter draws, over 1 for steeper ones.
ALPHA = 1.0
SEED = 7
_CHUNK = re.compile(r"\n| +[^ \n]*|[^ \n]+")
_P = np.uint64(0x9E3779B97F4A7C15)
#: Characters that are walked at once.
_BATCH = 200_000
#: Rows that are decoded at once.
_ROWS = 500
_NONE = np.iinfo(np.int32).min
_DENSE = 4


@dataclass
class Vocabulary:
    """pieces: bytes of each id, a space for the mark of a word's start; None for control pieces. start: ids of the
    256 bytes begin there."""

    pieces: list[bytes | None]
    first_byte: int

    @staticmethod
    def load(path: str) -> Vocabulary:
        from sentencepiece import SentencePieceProcessor

        m = SentencePieceProcessor(model_file=path)
        ids = range(m.get_piece_size())
        if not any(map(m.is_byte, ids)):
            raise ValueError("the vocabulary has no byte pieces")
        special = lambda i: m.is_control(i) or m.is_unknown(i) or m.is_unused(i)
        pieces = [None if special(i) else bytes([int(m.id_to_piece(i)[1:-1], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode() for i in ids]
        return Vocabulary(pieces, next(i for i in ids if m.is_byte(i)))

    def decode(self, ids) -> str:  # noqa: ANN001
        """The text of piece ids; the space that encoding puts in front goes."""
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8")[1:]


class _Numbers(dict):
    """Numbers its keys as they come."""

    def __missing__(self, key: str) -> int:
        value = self[key] = len(self)
        return value


def _rolled(points: np.ndarray) -> np.ndarray:
    return (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)


def _units(key: int, draw: int, place: int) -> Iterator[float]:
    """Numbers in (0, 1) for one word of one row."""
    state = xxhash.xxh64_intdigest(f"{key}:{draw}:{place}")
    while True:
        state = xxhash.xxh64_intdigest(state.to_bytes(8, "little"))
        yield (state >> 12) * 2.0**-52 + 2.0**-53


def _chosen(options: list[tuple[float, object]], u: float):  # noqa: ANN202
    """One of (log weight, item), by weight."""
    if len(options) == 1:
        return options[0][1]
    top = max(w for w, _ in options)
    mass = [math.exp(w - top) for w, _ in options]
    left = u * sum(mass)
    for m, (_, item) in zip(mass, options):
        left -= m
        if left <= 0:
            break
    return item


class Encoder:
    """Draws segmentations of batches of texts."""

    def __init__(self, vocabulary: Vocabulary, alpha: float = ALPHA, seed: int = SEED):
        self.v, self.seed = vocabulary, seed
        texts = {p.decode(): i for i, p in enumerate(vocabulary.pieces) if p is not None and not 0 <= i - vocabulary.first_byte < 256}
        if any(" " in p.lstrip(" ") or "\n" in p for p in texts):
            raise ValueError("a piece crosses the end of a word")
        ranked = np.arange(len(texts)) + 2.0
        self.logw = np.full(len(vocabulary.pieces), -np.inf)
        self.logw[sorted(texts.values())] = -np.log(ranked)  # pieces stand in order of frequency: Zipf's law
        self.logw[vocabulary.first_byte : vocabulary.first_byte + 256] = -np.log(len(texts) + 2.0)
        total = np.exp(self.logw).sum()
        self.logw = (alpha * (self.logw - np.log(total))).astype(np.float32).astype(np.float64)  # lattices hold 32 bits
        self.spelling = np.array(vocabulary.pieces, dtype=object)
        self.reach = max(map(len, texts))
        begun = {p[:n] for p in texts for n in range(1, len(p) + 1)}
        self.bits = 64 - (4 * len(begun)).bit_length()
        self.slots = np.zeros(1 << (64 - self.bits), np.uint64)  # hashes of the pieces' beginnings, by their first bits
        self.ids = np.full(len(self.slots), _NONE, np.int32)  # of the pieces; _NONE for mere beginnings
        for text in begun:
            h = self._hash(text)
            at = int(h) >> self.bits
            while self.slots[at]:
                at = (at + 1) % len(self.slots)
            self.slots[at], self.ids[at] = h, texts.get(text, _NONE)

    @staticmethod
    def _hash(piece: str) -> np.uint64:
        h = np.zeros(1, np.uint64)
        for c in piece:
            h = h * _P + _rolled(np.array([ord(c)]))
        return h[0]

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Slots of hashes, or -1."""
        found, rest, at = np.full(len(h), -1), np.arange(len(h)), (h >> np.uint64(self.bits)).astype(np.int64)
        while len(rest):
            there = self.slots[at]
            hit = there == h[rest]
            found[rest[hit]] = at[hit]
            more = (there != 0) & ~hit
            rest, at = rest[more], (at[more] + 1) % len(self.slots)
        return found

    def lattice(self, chunks: list[str]) -> None:
        """Lattices of the chunks, side by side.

        The chunks stand by length, longest first; a node is a chunk and the characters left to its end, and nodes of
        equally many left are neighbours. So the nodes of a level and those that their edges go to are slices of one
        array. The edge of n characters from a node has the number (n - 1) * nodes + node. beta is the log weight of
        all paths from a node, paths their number (up to 2^24), atleast the probability of an edge of n characters or
        more (-inf where the node has no edge of n characters, if n is large).
        """
        sizes = np.array([len(c) for c in chunks])
        order = np.argsort(-sizes, kind="stable")
        self.slot = np.empty(len(chunks), np.int64)
        self.slot[order] = np.arange(len(chunks))
        self.size = sizes = sizes[order]
        points = np.frombuffer("".join([chunks[i] for i in order]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        at_level = len(sizes) - np.cumsum(np.bincount(sizes))  # chunks of more characters
        at_level = np.concatenate([[len(sizes)], at_level[:-1]])
        self.base = np.cumsum(at_level) - at_level
        self.nodes = int(at_level.sum())
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(points))  # characters to the chunk's end
        node = self.base[left] + np.repeat(np.arange(len(chunks)), sizes)
        rolled, h, live, hits = _rolled(points), np.zeros(len(points), np.uint64), np.arange(len(points)), []
        while len(hits) < self.reach and len(live):
            inside = left[live] > len(hits)
            live = live[inside]
            h = h[inside] * _P + rolled[live + len(hits)]
            at = self._find(h)
            known = at >= 0
            live, h = live[known], h[known]
            ids = self.ids[at[known]]
            whole = ids != _NONE
            hits.append((node[live[whole]], ids[whole]))
        while len(hits) > 1 and not len(hits[-1][0]):
            hits.pop()
        self.piece = np.full((len(hits), self.nodes), _NONE, np.int32)
        self.atleast = np.full((len(hits), self.nodes), -np.inf, np.float32)
        self.longest = np.ones(self.nodes, np.int64)
        for n, (ends, ids) in enumerate(hits):
            self.piece[n, ends], self.atleast[n, ends], self.longest[ends] = ids, self.logw[ids], n + 1
        alone = self.piece[0, node] == _NONE  # characters that are no piece: their bytes are one edge
        code, which = np.unique(points[alone], return_inverse=True)
        width = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
        self.lone = [chr(c).encode("utf-8", "surrogatepass") for c in code]  # numbered behind the pieces
        self.weight = np.concatenate([self.logw, width * self.logw[self.v.first_byte]])
        number = np.where(code < 128, self.v.first_byte + code.astype(np.int64), len(self.logw) + np.arange(len(code)))[which]
        self.piece[0, node[alone]], self.atleast[0, node[alone]] = number, self.weight[number]
        self.beta, self.paths = np.zeros(self.nodes), np.ones(self.nodes, np.float32)
        few = [np.sort(ends) for ends, _ in hits[_DENSE:]]  # long edges are rare
        for d in range(1, len(at_level)):  # from the chunks' ends to their starts
            lo, m = self.base[d], at_level[d]
            n = min(d, _DENSE, len(hits))
            edges, top, count = np.empty((n, m)), np.full(m, -np.inf), np.zeros(m, np.float32)
            for j in range(n):
                to = slice(self.base[d - j - 1], self.base[d - j - 1] + m)
                np.add(self.atleast[j, lo : lo + m], self.beta[to], out=edges[j])
                np.maximum(top, edges[j], out=top)
                count += np.where(self.piece[j, lo : lo + m] != _NONE, self.paths[to], 0)
            long = []
            for j in range(_DENSE, min(d, len(hits))):
                ends = few[j - _DENSE]
                here = ends[slice(*np.searchsorted(ends, [lo, lo + m]))] - lo
                if len(here):
                    w = self.atleast[j, lo + here] + self.beta[self.base[d - j - 1] + here]
                    top[here] = np.maximum(top[here], w)
                    count[here] += self.paths[self.base[d - j - 1] + here]
                    long.append((j, here, w))
            total = np.zeros(m)
            for j, here, w in reversed(long):
                total[here] += np.exp(w - top[here])
                self.atleast[j, lo + here] = total[here]
            edges -= top
            np.exp(edges, out=edges)
            for j in range(n - 1, -1, -1):
                total += edges[j]
                edges[j] = total
            edges /= total
            self.atleast[:n, lo : lo + m] = edges
            for j, here, _ in long:
                self.atleast[j, lo + here] /= total[here]
            self.beta[lo : lo + m] = top + np.log(total)
            self.paths[lo : lo + m] = np.minimum(count, 1 << 24)

    def pick(self, nodes: np.ndarray, u: np.ndarray) -> np.ndarray:
        """Lengths of edges drawn from the nodes: the longest that has probability u with those above it."""
        n = self.longest[nodes]
        table, rest = self.atleast.ravel(), np.arange(len(nodes))
        while len(rest):
            rest = rest[table[(n[rest] - 1) * self.nodes + nodes[rest]] <= u[rest]]
            n[rest] -= 1
        return n

    @staticmethod
    def salted(key: np.ndarray, place: np.ndarray) -> np.ndarray:
        """What tells the words of all rows apart."""
        return key + place.astype(np.uint64) * _P

    @staticmethod
    def uniform(salt: np.ndarray, draw: int, step: int) -> np.ndarray:
        """In (0, 1), by row key and word of the row, draw and step; step 0 is the word's perturbation."""
        x = salt + np.uint64((draw * 0x632BE59BD9B4E019 + step * 0xD1342543DE82EF95) & 0xFFFFFFFFFFFFFFFF)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        x >>= np.uint64(12)
        u = x.astype(np.float64)
        u *= 2.0**-52
        u += 2.0**-53
        return u

    def walk(self, words: np.ndarray, salt: np.ndarray, draw: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A free draw for each word: edges of all, where each word's begin, log-probabilities."""
        slot = self.slot[words]
        left = self.size[slot]
        at = self.base[left] + slot
        only, logp = self.paths[at] == 1, -self.beta[at]
        pieces, count, visits, on, step = self.piece.ravel(), np.ones(len(words), np.int64), [], slice(None), 0
        while len(at):
            step += 1
            n = self.pick(at, self.uniform(salt, draw, step))
            edge = (n - 1) * self.nodes + at
            visits.append((on, edge))
            logp[on] += self.weight[pieces[edge]]
            left = left - n
            more = np.flatnonzero(left)
            on = more if step == 1 else on[more]
            count[on] += 1
            left, slot, salt = left[more], slot[more], salt[more]
            at = self.base[left] + slot
        logp = np.where(only, 0.0, np.minimum(logp, 0.0))
        begin = np.concatenate([[0], np.cumsum(count)])
        edges = np.empty(begin[-1], np.int64)
        for step, (on, edge) in enumerate(visits):
            edges[begin[:-1][on] + step] = edge
        return edges, begin, logp

    def logp(self, word: int, path: tuple[int, ...]) -> float:
        """Log-probability of a word's segmentation; 0 if it has no other."""
        first = self.base[self.size[self.slot[word]]] + self.slot[word]
        if self.paths.item(first) == 1:
            return 0.0
        return min(sum(self.weight.item(self.piece.item(e // self.nodes, e % self.nodes)) for e in path) - self.beta.item(first), 0.0)

    def elsewhere(self, word: int, taken: list[tuple[int, ...]], key: int, place: int, draw: int) -> tuple[int, ...]:
        """A draw for one word given that it is none of the taken segmentations: where it leaves them, then freely."""
        slot = int(self.slot[word])
        size = int(self.size[slot])
        unit = _units(key, draw, place)

        def leaving(path: tuple[int, ...]) -> list[tuple[float, int]]:
            """Edges from the path's end with their log weights, paths beyond them included."""
            left = size - sum(edge // self.nodes + 1 for edge in path)
            node = int(self.base[left]) + slot
            out = []
            for n in range(int(self.longest[node])):
                piece = self.piece.item(n, node)
                if piece != _NONE:
                    out.append((self.weight.item(piece) + self.beta.item(self.base.item(left - n - 1) + slot), n * self.nodes + node))
            return out

        follow: dict[tuple[int, ...], set[int]] = {}
        for path in taken:
            for n in range(len(path)):
                follow.setdefault(path[:n], set()).add(path[n])
        so_far: dict[tuple[int, ...], float] = {(): 0.0}
        options = []
        for path in sorted(follow, key=len):
            for w, edge in leaving(path):
                if edge in follow[path]:
                    so_far[*path, edge] = so_far[path] + self.weight.item(self.piece.item(edge // self.nodes, edge % self.nodes))
                else:
                    options.append((so_far[path] + w, (*path, edge)))
        path = _chosen(options, next(unit))
        while sum(edge // self.nodes + 1 for edge in path) < size:
            path = (*path, _chosen(leaving(path), next(unit)))
        return path

    def draw(self, texts: list[str], keys: list[int], k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
        """Per text up to k draws: piece ids, log-probability, perturbed value, log inclusion probability."""
        results: list[list] = [[] for _ in texts]
        for docs, ids, ends, *scores in self.draws(texts, keys, k):
            for d, part, *own in zip(docs.tolist(), np.split(ids, ends[:-1]), *(x.tolist() for x in scores)):
                results[d].append((part, *own))
        return results

    def draws(self, texts: list[str], keys: list[int], k: int) -> Iterator[tuple[np.ndarray, ...]]:
        """The first draws of all texts, then the second ones, and so on: the texts that have one, their piece ids
        one after the other, where each text's end, log-probabilities, perturbed values, log inclusion probabilities.
        """
        index = _Numbers()
        parts = [_CHUNK.findall(" " + t) for t in texts]
        sizes = np.array([len(p) for p in parts])
        words = np.fromiter(map(index.__getitem__, chain.from_iterable(parts)), np.int64, sizes.sum())
        self.lattice(list(index))
        doc, begin = np.repeat(np.arange(len(parts)), sizes), np.cumsum(sizes) - sizes
        place = np.arange(len(words)) - begin[doc]
        key = np.array(keys, np.uint64) ^ np.uint64(self.seed * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF)
        many = self.paths[self.base[self.size[self.slot[words]]] + self.slot[words]]
        salt = self.salted(key[doc], place)
        edges, starts, logp = self.walk(words, salt, 0)
        flat, n_flat = [edges], len(edges)
        at, size, logps, agenda = [starts[:-1]], [np.diff(starts)], [logp], []
        value = [-np.log(-np.log(self.uniform(self.salted(key, np.full(len(texts), -1)), 0, 0)))]
        has, taken = [np.ones(len(texts), bool)], {}

        def perturb(path: int, where: np.ndarray, log_rest: np.ndarray) -> None:
            """Bounds of what leaves the path at its words `where`; log_rest is the log mass of each word's others."""
            lp = logps[path]
            total = np.cumsum(lp)
            before = total - lp - np.repeat(np.concatenate([[0.0], total])[begin], sizes)
            noise = np.log(-np.log(self.uniform(salt[where], path + 1000, 0)))
            bound = np.full(len(words), -np.inf)
            with np.errstate(invalid="ignore"):
                bound[where] = -np.logaddexp(-value[path][doc[where]], noise - before[where] - log_rest)
            bound[where[~np.isfinite(log_rest)]] = -np.inf
            agenda.append(bound)

        def others(lp: np.ndarray, n: np.ndarray) -> np.ndarray:
            with np.errstate(divide="ignore"):
                return np.where(n > 1, np.log(np.maximum(-np.expm1(lp), 1e-300)), -np.inf)

        perturb(0, np.arange(len(words)), others(logp, many))
        for path in range(1, k + 1):
            tops = np.stack([np.maximum.reduceat(b, begin) for b in agenda])
            best = tops.argmax(axis=0)
            value.append(tops.max(axis=0))
            has.append(has[-1] & np.isfinite(value[-1]))
            if path == k:
                break
            new_at, new_size, new_logp = at[0].copy(), size[0].copy(), logps[0].copy()
            fresh = np.zeros(len(words), bool)
            turned, rests = [], []
            for d in np.flatnonzero(has[-1]):
                p, lo, hi = int(best[d]), begin[d], begin[d] + sizes[d]
                w = lo + int(agenda[p][lo:hi].argmax())
                agenda[p][w] = -np.inf
                own = lambda q: tuple(self.flat_at(flat, int(at[q][w]), int(size[q][w])))  # noqa: B023, E731
                gone = taken.pop((p, w), None) or [own(p)]
                seg = self.elsewhere(int(words[w]), gone, int(key[d]), int(place[w]), path)
                taken[(path, w)] = [*gone, seg]
                new_at[lo:w], new_size[lo:w], new_logp[lo:w] = at[p][lo:w], size[p][lo:w], logps[p][lo:w]
                new_at[w], new_size[w], new_logp[w] = n_flat, len(seg), self.logp(int(words[w]), seg)
                flat.append(np.array(seg))
                n_flat += len(seg)
                fresh[w + 1 : hi] = True
                turned.append(w)
                mass = sum(math.exp(self.logp(int(words[w]), s)) for s in taken[(path, w)])
                rests.append(np.log(max(1 - mass, 1e-18)) if many[w] > len(taken[(path, w)]) else -np.inf)
            where = np.flatnonzero(fresh)
            if len(where):
                edges, starts, logp = self.walk(words[where], salt[where], path)
                new_at[where], new_size[where], new_logp[where] = starts[:-1] + n_flat, np.diff(starts), logp
                flat.append(edges)
                n_flat += len(edges)
            flat = [np.concatenate(flat)]
            at.append(new_at)
            size.append(new_size)
            logps.append(new_logp)
            spots = np.concatenate([np.array(turned, np.int64), where])
            perturb(path, spots, np.concatenate([np.array(rests), others(new_logp[where], many[where])]))
        flat = np.concatenate(flat)
        for path in range(len(at)):
            total = np.add.reduceat(logps[path], begin)
            apart = total - value[-1]
            with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
                chosen = np.where(np.isfinite(value[-1]), np.where(apart < -30, apart, np.log(-np.expm1(-np.exp(np.minimum(apart, 700))))), 0.0)
            n = np.where(has[path][doc], size[path], 0)
            edges = flat[: n.sum()] if path == 0 else flat[np.repeat(at[path] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            ids = self.piece.ravel()[edges]
            docs = np.flatnonzero(has[path])
            ids, ends = self.spelled(ids, np.add.reduceat(n, begin).cumsum()[docs])
            yield docs, ids, ends, total[docs], value[path][docs], chosen[docs]

    @staticmethod
    def flat_at(flat: list[np.ndarray], at: int, size: int) -> list[int]:
        for part in flat:
            if at < len(part):
                return part[at : at + size].tolist()
            at -= len(part)
        raise IndexError(at)

    def spelled(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids with characters outside the vocabulary as the ids of their bytes, and where the texts end then."""
        lone = np.flatnonzero(ids >= len(self.logw))
        if not len(lone):
            return ids, ends
        spelled = [np.frombuffer(self.lone[i - len(self.logw)], np.uint8).astype(np.int32) + self.v.first_byte for i in ids[lone].tolist()]
        width = np.ones(len(ids), np.int64)
        width[lone] = [len(s) for s in spelled]
        out = np.repeat(ids, width)
        out[np.repeat(ids >= len(self.logw), width)] = np.concatenate(spelled)
        return out, np.concatenate([[0], np.cumsum(width)])[ends]


COLUMNS = "sample int, pieces array<int>, log_prob double, perturbed double, log_inclusion double, decodes boolean"


def _vocabulary(spark: SparkSession, model: str | None) -> Vocabulary:
    return Vocabulary.load(model or spark.conf.get(MODEL_SETTING, MODEL))


def sample_encodings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None, k: int = SAMPLES, alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """id and COLUMNS: up to k distinct segmentations per row, drawn without replacement, best perturbed value first.

    log_inclusion is the log-probability that a segmentation is among those above the next value in line; decodes
    tells that the pieces give the text back. Every character is covered, by byte pieces if need be. A text with
    fewer than k segmentations gives them all. An empty text has one of no pieces, a null text one of null pieces.
    Rows of equal id and text draw alike; an empty table gives an empty table; other columns are ignored. The
    vocabulary is the file `model`, else that of the setting MODEL_SETTING, else MODEL.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(_vocabulary(docs.sparkSession, model))

    def encode(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.value, alpha, seed)
        for frame in frames:
            sizes = np.array(pc.fill_null(pc.binary_length(frame.column(1)), 0).to_pylist(), np.int64)
            part = np.cumsum(sizes) // _BATCH
            for start, stop in zip(*(lambda cut: (cut, [*cut[1:], len(sizes)]))(np.flatnonzero(np.diff(part, prepend=-1)).tolist())):
                yield from _encoded(encoder, frame.column(0)[start:stop], frame.column(1)[start:stop], k)

    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(encode, f"id {kind}, {COLUMNS}").withColumnRenamed("id", id_col)


def _encoded(encoder: Encoder, ids: pa.Array, texts: pa.Array, k: int) -> Iterator[pa.RecordBatch]:
    """The draws of a batch of rows, and one row for each null or empty text."""
    keys, rows = ids.to_pylist(), texts.to_pylist()

    def table(at: np.ndarray, sample: int, pieces: pa.Array, *scores: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([ids.take(pa.array(at)), pa.array(np.full(len(at), sample, np.int32)), pieces, *scores], ["id", *(x.split()[0] for x in COLUMNS.split(", "))])

    bare = np.array([i for i, t in enumerate(rows) if not t], np.int64)
    if len(bare):
        known = [rows[i] is not None for i in bare]
        zero = pa.array(np.zeros(len(bare)))
        yield table(bare, 1, pa.array([[] if x else None for x in known], pa.list_(pa.int32())), zero, pa.nulls(len(bare), pa.float64()), zero, pa.array([x or None for x in known], pa.bool_()))
    full = np.array([i for i, t in enumerate(rows) if t], np.int64)
    if not len(full):
        return
    seeds = [xxhash.xxh64_intdigest("" if keys[i] is None else str(keys[i])) for i in full]
    for sample, (docs, pieces, ends, *scores) in enumerate(encoder.draws([rows[i] for i in full], seeds, k), 1):
        if not len(docs):
            continue
        decoded = encoder.spelling[pieces].tolist()
        starts = np.concatenate([[0], ends[:-1]])
        good = [b"".join(decoded[lo:hi])[1:] == rows[full[d]].encode("utf-8", "surrogatepass") for d, lo, hi in zip(docs.tolist(), starts.tolist(), ends.tolist())]
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, ends[-1]), pa.int32()), pa.array(pieces, pa.int32()))
        yield table(full[docs], sample, lists, *map(pa.array, scores), pa.array(good, pa.bool_()))


def decoded_texts(pieces: pa.Array, spelling: pa.Array) -> pa.Array:
    """Texts of lists of piece ids; ids that spell nothing (control pieces, nulls, numbers outside) give nothing."""
    pieces = pieces.combine_chunks() if isinstance(pieces, pa.ChunkedArray) else pieces
    ids = pc.if_else(pc.and_(pc.greater_equal(pieces.flatten(), 0), pc.less(pieces.flatten(), len(spelling))), pieces.flatten(), None)
    spelled = pc.fill_null(spelling.take(ids), b"")
    sizes = pc.fill_null(pc.list_value_length(pieces), 0).to_numpy(zero_copy_only=False)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), spelled)
    known = pieces.is_valid().to_pylist()
    return pa.array([raw[1:].decode("utf-8", "replace") if is_list else None for raw, is_list in zip(pc.binary_join(lists, b"").to_pylist(), known)], pa.string())


def decoded_in_parts(pieces: pa.Array, spelling: pa.Array) -> pa.Array:
    """decoded_texts() of some rows at a time: what a row takes while it is decoded is several times its text."""
    return pa.concat_arrays([decoded_texts(pieces[at : at + _ROWS], spelling) for at in range(0, len(pieces) or 1, _ROWS)])


def decode(encoded: DataFrame, pieces_col: str = "pieces", text_col: str = "text", model: str | None = None) -> DataFrame:
    """encoded with the text of its pieces in text_col, which replaces a column of that name.

    The space that encoding puts in front goes. No pieces are an empty text, null pieces a null one; control pieces,
    nulls and numbers outside of the vocabulary give nothing, and bytes that are no UTF-8 the replacement character.
    Repeated rows stay, an empty table gives an empty table. The vocabulary is chosen as in sample_encodings().
    """
    vocabulary = encoded.sparkSession.sparkContext.broadcast(_vocabulary(encoded.sparkSession, model).pieces)

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        spelling = pa.array(vocabulary.value, pa.binary())
        for batch in batches:
            yield decoded_in_parts(batch, spelling)

    return encoded.withColumn(text_col, texts(F.col(pieces_col)))
