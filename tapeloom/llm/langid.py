"""Tell the language of a text by pieces, summing over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. A
word's probability is the sum over all ways to cut it into pieces, by a forward
pass; a text's is the product over its words. The piece probabilities are fitted
by expectation maximisation on a bounded sample of labelled texts: expected piece
counts come from forward and backward passes over the sample's words, also summed
over all segmentations.

Words are bytes with a blank in front, as the vocabulary marks word starts; its 256
byte pieces cover whatever nothing else does. Passes run over many words of one
length at once, a step for each end and piece length. Tasks keep the probabilities
of words that they have seen.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from . import common, textarrays as ta
from .textarrays import U64

#: Texts per language, in expectation, that the fit may see.
SAMPLE = 1500
ROUNDS = 3
#: Added to every expected count.
SMOOTH = 0.1
#: Longer words are passed one by one, with rescaled sums.
LONG = 48
#: Probabilities are scaled by this for each byte, to keep products in range.
SCALE = 8.0
TOGETHER = 20_000
SLICE = 1 << 21
REMEMBERED = 1 << 20
UNKNOWN = "und"

_BASE = U64(0x9E3779B97F4A7C15)
_TABLE = 20


def vocabulary(path: str | None = None) -> list[bytes]:
    """The pieces as bytes, a blank for the mark of a word's start; read on the driver."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {bytes([b]) for b in range(256)}
    for i in range(model.get_piece_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces.add(model.id_to_piece(i).replace("▁", " ").encode())
    return sorted(p for p in pieces if p)


class Pieces:
    """Finds the pieces in many words at once, by the hash of every stretch."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        self.longest = max(map(len, pieces))
        self._hashes = np.array([self._hash(p) for p in pieces], U64)
        if len(np.unique(self._hashes)) < len(pieces):
            raise ValueError("two pieces have one hash")
        self._hashes = np.append(self._hashes, U64(0))
        self._tables, left = [], np.arange(len(pieces))
        while len(left):
            table = np.full(1 << _TABLE, len(pieces), np.int32)
            slot = self._slots(self._hashes[left], len(self._tables))
            table[slot] = left
            self._tables.append(table)
            left = left[table[slot] != left]

    @staticmethod
    def _hash(piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * int(_BASE) + int(ta.BYTE[b])) & ((1 << 64) - 1)
        return h

    @staticmethod
    def _slots(hashes: np.ndarray, number: int) -> np.ndarray:
        return (ta.mix(hashes + U64(number)) >> U64(64 - _TABLE)).astype(np.int64)

    def find(self, words: np.ndarray) -> list[np.ndarray]:
        """For rows of words of one length: element d - 1 has, for each start, the piece of d bytes there, or `len(pieces)`."""
        values, out = ta.BYTE[words], []
        rolling = np.zeros_like(values)
        for d in range(1, min(self.longest, words.shape[1]) + 1):
            rolling = rolling[:, : words.shape[1] - d + 1] * _BASE + values[:, d - 1 :]
            found = np.full(rolling.shape, len(self.pieces), np.int32)
            for number, table in enumerate(self._tables):
                at = table[self._slots(rolling, number)]
                hit = (self._hashes[at] == rolling) & (at < len(self.pieces))
                found[hit] = at[hit]
            out.append(found)
        return out


def _ahead(found: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """Sums over all segmentations of each word's first bytes: (word, bytes, language)."""
    n, size = found[0].shape
    total = np.zeros((n, size + 1, weights.shape[1]))
    total[:, 0] = 1.0
    for j in range(1, size + 1):
        for d in range(1, min(len(found), j) + 1):
            piece = found[d - 1][:, j - d]
            if (piece < len(weights) - 1).any():
                total[:, j] += total[:, j - d] * weights[piece]
    return total


def _behind(found: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    n, size = found[0].shape
    total = np.zeros((n, size + 1, weights.shape[1]))
    total[:, size] = 1.0
    for i in range(size - 1, -1, -1):
        for d in range(1, min(len(found), size - i) + 1):
            piece = found[d - 1][:, i]
            if (piece < len(weights) - 1).any():
                total[:, i] += total[:, i + d] * weights[piece]
    return total


@dataclass
class Model:
    """Piece probabilities, a column per language; the last row is no piece."""

    pieces: list[bytes]
    langs: list[str]
    probabilities: np.ndarray
    _finder: Pieces | None = field(default=None, repr=False)

    def __getstate__(self):
        return {"pieces": self.pieces, "langs": self.langs, "probabilities": self.probabilities, "_finder": None}

    @property
    def finder(self) -> Pieces:
        if self._finder is None:
            self._finder = Pieces(self.pieces)
        return self._finder

    @property
    def weights(self) -> np.ndarray:
        sizes = np.array([*map(len, self.pieces), 0])
        return np.vstack([self.probabilities, np.zeros(self.probabilities.shape[1])]) * (SCALE**sizes)[:, None]

    def long_word(self, word: bytes) -> np.ndarray:
        """Log probability of a word of any length; sums are rescaled at every byte."""
        weights = np.vstack([self.probabilities, np.zeros(len(self.langs))])
        found = self.finder.find(np.frombuffer(word, np.uint8)[None, :])
        reach = len(found)
        recent = np.zeros((reach + 1, len(self.langs)))
        recent[0] = 1.0
        logs = np.zeros(len(self.langs))
        for j in range(1, len(word) + 1):
            now = np.zeros(len(self.langs))
            for d in range(1, min(reach, j) + 1):
                now += recent[d - 1] * weights[found[d - 1][0, j - d]]
            recent = np.vstack([now, recent[:-1]])
            top = recent.max(axis=0)
            recent /= top
            logs += np.log(top)
        return logs + np.log(recent[0])

    def words(self, words: list[bytes]) -> np.ndarray:
        """Log probability of each word, given with its blank: (word, language)."""
        out = np.zeros((len(words), len(self.langs)))
        sizes = np.array([len(w) for w in words])
        weights = self.weights
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            if size > LONG:
                for i in at:
                    out[i] = self.long_word(words[i])
                continue
            for some in np.array_split(at, -(-len(at) // TOGETHER)):
                matrix = np.frombuffer(b"".join(words[i] for i in some), np.uint8).reshape(len(some), size)
                out[some] = np.log(_ahead(self.finder.find(matrix), weights)[:, size]) - size * np.log(SCALE)
        return out

    def _add_long(self, out: np.ndarray, word: bytes, counts: np.ndarray) -> None:
        """Add the expected piece counts of a word of any length; sums are logarithms."""
        with np.errstate(divide="ignore"):
            logs = np.log(np.vstack([self.probabilities, np.zeros(len(self.langs))]))
        found = [starts[0] for starts in self.finder.find(np.frombuffer(word, np.uint8)[None, :])]
        size, reach = len(word), len(found)
        begins, ends = (np.full((size + 1, reach), len(self.pieces), np.int32) for _ in range(2))
        for d, starts in enumerate(found, 1):
            begins[: size - d + 1, d - 1] = ends[d:, d - 1] = starts
        # Nothing comes before the word or after it.
        ahead, behind = (np.full((size + 1 + reach, len(self.langs)), -np.inf) for _ in range(2))
        ahead[reach] = behind[size] = 0.0
        for j in range(1, size + 1):
            ahead[reach + j] = np.logaddexp.reduce(ahead[j : reach + j][::-1] + logs[ends[j]])
        for i in range(size - 1, -1, -1):
            behind[i] = np.logaddexp.reduce(behind[i + 1 : i + 1 + reach] + logs[begins[i]])
        for d, starts in enumerate(found, 1):
            start = np.flatnonzero(starts < len(self.pieces))
            piece = starts[start]
            np.add.at(out, piece, np.exp(ahead[reach + start] + logs[piece] + behind[start + d] - behind[0]) * counts)

    def expected(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """Expected piece counts by language for words seen `counts` (word, language) times."""
        out = np.zeros((len(self.pieces) + 1, len(self.langs)))
        sizes = np.array([len(w) for w in words])
        weights = self.weights
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            if size > LONG:
                for i in at:
                    self._add_long(out, words[i], counts[i])
                continue
            for some in np.array_split(at, -(-len(at) // TOGETHER)):
                matrix = np.frombuffer(b"".join(words[i] for i in some), np.uint8).reshape(len(some), size)
                found = self.finder.find(matrix)
                ahead, behind = _ahead(found, weights), _behind(found, weights)
                share = counts[some] / ahead[:, size]
                for d, starts in enumerate(found, 1):
                    row, start = np.nonzero(starts < len(self.pieces))
                    piece = starts[row, start]
                    mass = ahead[row, start] * weights[piece] * behind[row, start + d] * share[row]
                    for lang in range(len(self.langs)):
                        out[:, lang] += np.bincount(piece, mass[:, lang], len(out))
        return out[:-1]


# --- fitting -------------------------------------------------------------------------


def held_out(identity: Column) -> Column:
    """Rows that nothing is learned from; a NULL id is not held out."""
    return F.coalesce(F.crc32(identity.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) of rows (lang, text)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, Counter] = {}
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts.setdefault(lang, Counter()).update(text.encode().split())
            rows = [(lang, b" " + word, n) for lang, own in counts.items() for word, n in own.items()]
            columns = list(zip(*rows, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.binary(), pa.int64()), strict=True)], names=["lang", "word", "n"]
            )

    return docs.mapInArrow(task, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def sample(docs: DataFrame, lang: str, text: str, per_lang: int) -> DataFrame:
    """(lang, text) of about `per_lang` texts of each language, chosen by the hash of the text."""
    rows = docs.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    # Written, so that Spark knows how small it is and leaves the texts where they are.
    sizes = common.stored(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("texts")), "langid-sizes", 1)
    share = F.least(F.lit(1.0), F.lit(float(per_lang)) / F.col("texts"))
    return rows.join(sizes, "lang").where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < share * (1 << 30)).select("lang", "text")


def fit(docs: DataFrame, lang: str = "lang", text: str = "text", path: str | None = None, per_lang: int = SAMPLE, rounds: int = ROUNDS) -> Model:
    """Piece probabilities of every language of the labelled rows."""
    words = common.stored(_word_counts(sample(docs, lang, text, per_lang)), "langid-words")
    langs = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    pieces = vocabulary(path)
    # Shorter pieces first to be likelier, in all languages alike.
    start = np.array([0.5 ** len(p) for p in pieces])
    model = Model(pieces, langs, np.repeat((start / start.sum())[:, None], len(langs), axis=1))
    context = docs.sparkSession.sparkContext
    for _ in range(rounds if langs else 0):
        shared = context.broadcast(model)

        def task(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            total = np.zeros((len(own.pieces), len(own.langs)))
            place = {name: i for i, name in enumerate(own.langs)}
            for batch in batches:
                name, word, n = (c.to_pylist() for c in batch.columns)
                counts = np.zeros((len(word), len(own.langs)))
                counts[np.arange(len(word)), [place[x] for x in name]] = n
                total += own.expected(word, counts)
            piece, at = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece, pa.int32()), pa.array(at, pa.int32()), pa.array(total[piece, at])], names=["piece", "lang", "n"]
            )

        # A number per piece and language.
        sums = words.select("lang", "word", "n").mapInArrow(task, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
        counts = np.full((len(pieces), len(langs)), SMOOTH)
        for row in sums.toLocalIterator():
            counts[row["piece"], row["lang"]] += row["n"]
        model = Model(pieces, langs, counts / counts.sum(axis=0))
    return model


# --- scoring -------------------------------------------------------------------------


class _Memory:
    """Log probabilities of words seen before, by the hash of the word."""

    def __init__(self, model: Model):
        self.model = model
        self.keys = np.zeros(0, U64)
        self.logs = np.zeros((0, len(model.langs)))

    def of(self, keys: np.ndarray, word) -> np.ndarray:
        """For different ascending keys; word(i) gives the bytes of the i-th."""
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == keys
        new = np.flatnonzero(~known)
        out = np.zeros((len(keys), len(self.model.langs)))
        out[known] = self.logs[at[known]]
        if len(new):
            out[new] = self.model.words([word(i) for i in new.tolist()])
            if len(self.keys) + len(new) > REMEMBERED:
                self.keys, self.logs = keys, out
            else:
                merged = np.concatenate([self.keys, keys[new]])
                order = np.argsort(merged, kind="stable")
                self.keys, self.logs = merged[order], np.concatenate([self.logs, out[new]])[order]
        return out


def _lettered(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which texts have a letter."""
    folded = data | 0x20
    plain = np.concatenate([[0], np.cumsum((folded >= 97) & (folded <= 122) & (data < 128))])
    out = plain[at[1:]] > plain[at[:-1]]
    for i in np.flatnonzero(~out):
        own = data[at[i] : at[i + 1]]
        out[i] = (own > 127).any() and any(c.isalpha() for c in own.tobytes().decode("utf-8", "replace"))
    return out


def log_likelihoods(column: pa.Array, memory: _Memory) -> tuple[np.ndarray, np.ndarray]:
    """(text, language) log probabilities of whole texts, and which texts have a letter."""
    data, offsets = ta.flat(column)
    sums, letters = [], []
    for a, b in ta.parts(offsets, SLICE):
        own, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        words = ta.Words(own, at)
        keys, first, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
        logs = memory.of(keys, lambda i: b" " + own[words.start[first[i]] : words.end[first[i]]].tobytes())[inverse]  # noqa: B023
        text = np.repeat(np.arange(b - a), np.diff(words.first))
        sums.append(np.stack([np.bincount(text, column, b - a) for column in logs.T], axis=1))
        letters.append(_lettered(own, at))
    if not sums:
        return np.zeros((0, len(memory.model.langs))), np.zeros(0, bool)
    return np.concatenate(sums), np.concatenate(letters)


def predict(docs: DataFrame, model: Model, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, lang_pred, score): the likeliest language and its posterior under equal priors.

    `und` with score 0 if the text is NULL or has no letter, or nothing was learned;
    the first language by name on ties. Repeated rows get the same answer. An empty
    table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Memory(shared.value)
        langs = np.array([*shared.value.langs, UNKNOWN], object)
        for batch in batches:
            if len(langs) == 1:
                best, score = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            else:
                logs, letters = log_likelihoods(batch.column(1), memory)
                best = np.where(letters, np.argmax(logs, axis=1), len(langs) - 1)
                top = logs.max(axis=1)
                score = np.where(letters, 1 / np.exp(logs - top[:, None]).sum(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs[best], pa.string()), pa.array(score)], names=[identity, "lang_pred", "score"]
            )

    schema = T.StructType([docs.schema[identity], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.select(F.col(f"`{identity}`"), F.col(f"`{text}`")).mapInArrow(task, schema)
