"""Language identification by unigram pieces, all segmentations summed.

Words are lower-cased and given a leading space mark; the probability of a word
in a language is the sum over every way to cut it into pieces of a fixed public
vocabulary, computed by the forward algorithm. Piece probabilities per language
come from expected counts (forward-backward) on labelled documents.

Words of any length are summed whole; beyond ``WORD`` characters the sums are kept as
logarithms, which changes nothing but their range. A character outside the vocabulary
counts as a piece of probability ``UNSEEN``.
Nulls: a null text, or one without a letter (``str.isalpha``), gives ``und`` with score 0.
Repeated rows each get a row. Without labelled rows every document is ``und``.
"""

from __future__ import annotations

import math
import pickle
import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.batches import text_slices
from ledgerlens.llm.memo import WordMemo, held
from ledgerlens.session import materialize

#: Words up to this length are summed without logarithms.
WORD = 40
#: Characters whose matches are held at a time, or one longer word.
HELD = 200_000
UNSEEN = 1e-7
#: Probabilities are scaled by this per character, so that products stay near one.
SCALE = 10.0
LETTER = re.compile(r"[^\W\d_]")  # or a number that is no decimal digit
MARK = "▁"
#: Bits of a piece's length in a finder's value.
LENGTH = 16


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in LETTER.finditer(text))


def vocabulary(path: str) -> tuple[ahocorasick.Automaton, int]:
    """Finder of the lower-case pieces of a SentencePiece model (value: number, length), and their count."""
    return held("language", ("pieces", path), lambda: _vocabulary(path))


def _vocabulary(path: str) -> tuple[ahocorasick.Automaton, int]:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    finder, count = ahocorasick.Automaton(), 0
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        odd = model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
        if odd or piece != piece.lower() or "\n" in piece:
            continue
        finder.add_word(piece, count << LENGTH | len(piece))
        count += 1
    finder.make_automaton()
    return finder, count


class Lattice:
    """All vocabulary matches in a list of words, ready for sums over segmentations."""

    def __init__(self, words: list[str], path: str):
        finder, unseen = vocabulary(path)
        marked = [MARK + w for w in words]
        text = "\n".join(marked)
        sizes = np.array([len(w) for w in marked], dtype=np.int64)
        self.begin = np.concatenate(([0], np.cumsum(sizes + 1)[:-1])).astype(np.int64)
        self.stop = self.begin + sizes
        self.size, self.n = len(text) + 1, len(words)
        found = np.fromiter(chain.from_iterable(finder.iter(text)), dtype=np.int64).reshape(-1, 2)
        end, piece, length = found[:, 0] + 1, found[:, 1] >> LENGTH, found[:, 1] & ((1 << LENGTH) - 1)
        alone = np.zeros(self.size, dtype=bool)
        alone[end[length == 1]] = True
        alone[self.stop[:-1] + 1] = True  # separators
        missing = np.flatnonzero(~alone[1:]) + 1
        end = np.concatenate((end, missing))
        piece = np.concatenate((piece, np.full(len(missing), unseen)))
        start = end - np.concatenate((length, np.ones(len(missing), dtype=np.int64)))
        word = np.searchsorted(self.begin, start, side="right") - 1
        order = np.lexsort((end, end - self.begin[word]))
        self.start, self.end, self.piece, self.word = start[order], end[order], piece[order], word[order]
        self.steps = self._groups(self.end - self.begin[self.word])

    @staticmethod
    def _groups(key: np.ndarray) -> list[slice]:
        edges = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
        return [slice(a, b) for a, b in zip(edges, edges[1:], strict=False) if b > a]

    def forward(self, weights: np.ndarray, logs: bool = False) -> np.ndarray:
        """Mass of all paths to each position. ``weights``: one row per match; with ``logs`` both are logarithms."""
        mass = np.full((self.size, weights.shape[1]), -np.inf if logs else 0.0)
        mass[self.begin] = 0.0 if logs else 1.0
        for step in self.steps:
            self._add(mass, self.end[step], self._times(mass[self.start[step]], weights[step], logs), logs)
        return mass

    def backward(self, weights: np.ndarray, logs: bool = False) -> np.ndarray:
        mass = np.full((self.size, weights.shape[1]), -np.inf if logs else 0.0)
        mass[self.stop] = 0.0 if logs else 1.0
        # Positions count from the end of the word, so that words of any length start together.
        left = self.stop[self.word] - self.start
        order = np.lexsort((self.start, left))
        for step in self._groups(left[order]):
            mine = order[step]
            self._add(mass, self.start[mine], self._times(mass[self.end[mine]], weights[mine], logs), logs)
        return mass

    @staticmethod
    def _times(mass: np.ndarray, weights: np.ndarray, logs: bool) -> np.ndarray:
        return mass + weights if logs else mass * weights

    @staticmethod
    def _add(mass: np.ndarray, at: np.ndarray, amounts: np.ndarray, logs: bool) -> None:
        first = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
        if logs:
            mass[at[first]] = np.logaddexp(mass[at[first]], np.logaddexp.reduceat(amounts, first, axis=0))
        else:
            mass[at[first]] += np.add.reduceat(amounts, first, axis=0)

    def scaled(self, table: np.ndarray) -> np.ndarray:
        """Rows of ``table`` by piece, scaled by the piece's length."""
        return table[self.piece] * (SCALE ** (self.end - self.start))[:, None]


def _held(words: list[str]) -> Iterator[tuple[np.ndarray, bool]]:
    """Places of words to be summed together, and whether as logarithms: by kind, within ``HELD`` characters."""
    sizes = np.array([len(w) for w in words], np.int64)
    for logs in (False, True):
        mine = np.flatnonzero((sizes > WORD) == logs)
        group = (np.cumsum(sizes[mine]) - sizes[mine]) // HELD
        for part in np.split(mine, np.flatnonzero(np.diff(group)) + 1):
            if len(part):
                yield part, logs


def log_probabilities(words: list[str], table: np.ndarray, path: str) -> np.ndarray:
    """(words, languages): log of the summed probability of all segmentations."""
    out = np.zeros((len(words), table.shape[1]))
    for part, logs in _held(words):
        lattice = Lattice([words[i] for i in part], path)
        if logs:
            out[part] = lattice.forward(np.log(table[lattice.piece]), True)[lattice.stop]
        else:
            mass = lattice.forward(lattice.scaled(table))[lattice.stop]
            out[part] = np.log(mass) - (math.log(SCALE) * (lattice.stop - lattice.begin))[:, None]
    return out


def expected_counts(words: list[str], amounts: np.ndarray, langs: np.ndarray, table: np.ndarray, path: str) -> np.ndarray:
    """(pieces + 1, languages): expected uses of each piece in ``amounts`` copies of the words."""
    out = np.zeros(table.size)
    for part, logs in _held(words):
        lattice = Lattice([words[i] for i in part], path)
        lang = langs[part][lattice.word]
        if logs:
            weights = np.log(table[lattice.piece, lang])
            ahead, behind = lattice.forward(weights[:, None], True)[:, 0], lattice.backward(weights[:, None], True)[:, 0]
            share = np.exp(ahead[lattice.start] + weights + behind[lattice.end] - ahead[lattice.stop][lattice.word])
        else:
            weights = table[lattice.piece, lang] * SCALE ** (lattice.end - lattice.start)
            ahead, behind = lattice.forward(weights[:, None])[:, 0], lattice.backward(weights[:, None])[:, 0]
            share = ahead[lattice.start] * weights * behind[lattice.end] / ahead[lattice.stop][lattice.word]
        out += np.bincount(lattice.piece * table.shape[1] + lang, share * amounts[part][lattice.word], table.size)
    return out.reshape(table.shape)


class LanguageModel:
    """Languages in order and, per piece (the last row: unseen characters), their probabilities."""

    def __init__(self, langs: list[str], table: np.ndarray, path: str):
        self.langs, self.table, self.path = langs, table, path


def _normalised(counts: np.ndarray) -> np.ndarray:
    table = counts + 0.01
    table /= table.sum(axis=0)
    table[-1] = UNSEEN
    return table


def _words(text: str) -> list[str]:
    return text.lower().split()


def train(labelled: DataFrame, path: str, docs_per_language: int = 3_000, rounds: int = 3) -> LanguageModel:
    """Piece probabilities from ``doc_id, text, lang`` rows.

    At most about ``docs_per_language`` documents of each language are used,
    chosen by the hash of their id; their texts are used whole. The table brought
    to the driver has one row per vocabulary piece and language.
    """
    rows = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    pieces = vocabulary(path)[1]
    if not langs:
        return LanguageModel([], np.zeros((pieces + 1, 0)), path)
    number = {lang: i for i, lang in enumerate(langs)}
    share = F.element_at(
        F.create_map(*chain.from_iterable((F.lit(k), F.lit(docs_per_language / n)) for k, n in sizes.items())),
        F.col("lang"),
    )
    chosen = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000)) < share * 1_000_000

    def count(batches):
        # Counted per slice first: frequent words leave the task once per slice.
        for batch, texts in text_slices(batches, "text", rows=2_000, characters=4_000_000):
            seen: dict[tuple[str, str], int] = {}
            for text, lang in zip(texts, batch.column("lang").to_pylist(), strict=True):
                for word in _words(text):
                    seen[lang, word] = seen.get((lang, word), 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in seen]), pa.array([k[1] for k in seen]), pa.array(list(seen.values()), pa.int64())],
                ["lang", "word", "n"],
            )

    counted = rows.where(chosen).select("text", "lang").mapInArrow(count, "lang string, word string, n long")
    counted = materialize(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    table = np.full((pieces + 1, len(langs)), 1.0 / pieces)
    table[-1] = UNSEEN
    for _ in range(rounds):
        shared = labelled.sparkSession.sparkContext.broadcast(pickle.dumps(table))

        def expect(batches, shared=shared):
            table = pickle.loads(shared.value)
            total = np.zeros_like(table)
            for batch in batches:
                for start in range(0, batch.num_rows, 5_000):
                    part = batch.slice(start, 5_000)
                    found = [number[lang] for lang in part.column("lang").to_pylist()]
                    amounts = np.array(part.column("n").to_pylist(), dtype=np.float64)
                    total += expected_counts(part.column("word").to_pylist(), amounts, np.array(found), table, path)
            piece, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece), pa.array(lang), pa.array(total[piece, lang])], ["piece", "lang", "n"]
            )

        sums = counted.mapInArrow(expect, "piece long, lang long, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
        found = sums.toPandas()
        counts = np.zeros_like(table)
        counts[found["piece"].to_numpy(), found["lang"].to_numpy()] = found["n"].to_numpy()
        table = _normalised(counts)
        shared.unpersist()
    return LanguageModel(langs, table, path)


def scorer(key: str, blob: bytes) -> tuple[LanguageModel, WordMemo]:
    """The model of a broadcast and this worker's memory of word scores under it."""

    kept = held("language", "scores", dict)
    if key not in kept:
        kept.clear()
        model = pickle.loads(blob)

        def score(words: list[str]):
            for start in range(0, len(words), 20_000):
                logs = log_probabilities(words[start : start + 20_000], model.table, model.path)
                yield from (row.tobytes() for row in logs)

        kept[key] = model, WordMemo(score, keep=200_000, recent=50_000)
    return kept[key]


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", keep=()) -> DataFrame:
    """``id_col, lang_pred, score`` and the columns named in ``keep`` for every row.

    ``score`` is the probability of the predicted language among the learned ones.
    """
    import uuid

    key = uuid.uuid4().hex
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    kept = [id_col, *keep]

    def run(batches):
        model, memo = scorer(key, shared.value)
        for batch, texts in text_slices(batches, "text"):
            split = [_words(t) if t and model.langs and has_letter(t) else [] for t in texts]
            preds, scores = [], []
            for words, data in zip(split, memo.joined(split), strict=True):
                if not words:
                    preds.append("und")
                    scores.append(0.0)
                    continue
                total = np.frombuffer(data).reshape(len(words), -1).sum(axis=0)
                best = int(total.argmax())
                preds.append(model.langs[best])
                scores.append(1.0 / float(np.exp(total - total[best]).sum()))
            columns = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(preds, pa.string()), pa.array(scores, pa.float64())],
                [*[f"c{i}" for i in range(len(kept))], "lang_pred", "score"],
            )

    fields = [docs.schema[c] for c in kept]
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.col(f"`{text_col}`").alias("text"))
    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(fields))
    out = inner.mapInArrow(run, f"{schema}, lang_pred string, score double")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], "lang_pred", "score")


def held_out(id_col: str = "doc_id"):
    """True for the fifth of the documents that is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))
