"""SentencePiece BPE encoding by backtracking, and decoding.

A sequence of pieces is the model's encoding exactly when every two neighbours
are: merging the characters of both from scratch gives the two back. The encoder
therefore walks the text with the longest vocabulary match at each position
(Aho-Corasick), keeps a match only if it is compatible with the piece before it,
falls back to its next shorter prefix otherwise, and marks positions from which
no continuation exists in a bit field so that none is tried twice.

Nulls: a null text encodes like the empty text (the end id alone); null ids
decode to the empty text. Repeated rows each give their own row.
"""

from __future__ import annotations

import re
from array import array
from itertools import pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.batches import list_array, text_slices
from ledgerlens.llm.memo import WordMemo, held

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
NEVER = float("-inf")
#: Pairs of neighbours whose compatibility a worker remembers.
PAIRS = 300_000


class PieceModel:
    """The tables of a SentencePiece BPE model with byte fallback and no normalisation rules."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        rules, trainer = proto.normalizer_spec, proto.trainer_spec
        if (
            trainer.model_type != trainer.BPE
            or not trainer.byte_fallback
            or trainer.treat_whitespace_as_suffix
            or rules.precompiled_charsmap
            or rules.remove_extra_whitespaces
            or not (rules.add_dummy_prefix and rules.escape_whitespaces)
            or {p.type for p in proto.pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}
        ):
            raise ValueError(f"{path}: only plain BPE models with byte fallback and a leading space are covered")
        self.names = [p.piece for p in proto.pieces]
        self.kinds = [p.type for p in proto.pieces]
        self.score = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.byte_ids = [0] * 256
        self.bytes_of = {}
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                self.byte_ids[int(p.piece[1:-1], 16)] = i
                self.bytes_of[i] = int(p.piece[1:-1], 16)
        self.characters = {p for p in self.ids if len(p) == 1}
        # What a piece adds to a decoded text; None if that depends on its neighbours.
        self.surface = [
            name.replace(SPACE, " ") if kind == NORMAL else "" if kind == CONTROL else None
            for name, kind in zip(self.names, self.kinds, strict=True)
        ]
        for i, b in self.bytes_of.items():
            self.surface[i] = chr(b) if b < 128 else None
        self.pairs: dict[tuple[str, str], bool] = {}
        self.matcher, self.shorter = self._matches()
        self.cut = self._cut()

    def merge(self, text: str) -> list[str]:
        """The pieces that repeated best-score merging of neighbours ends with."""
        parts, get = list(text), self.score.get
        scores = [get(a + b, NEVER) for a, b in pairwise(parts)]
        while scores and (best := max(scores)) > NEVER:
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = get(parts[at - 1] + parts[at], NEVER)
            if at < len(scores):
                scores[at] = get(parts[at] + parts[at + 1], NEVER)
        return parts

    def _matches(self) -> tuple[ahocorasick.Automaton, dict[str, str]]:
        """Finder of the pieces that encode to themselves, and each one's longest proper prefix among them."""
        own = {p for p in self.ids if len(p) == 1 or self.merge(p) == [p]}
        matcher = ahocorasick.Automaton()
        for piece in own:
            matcher.add_word(piece, piece)
        matcher.make_automaton()
        shorter = {}
        for piece in own:
            for end in range(len(piece) - 1, 0, -1):
                if piece[:end] in own:
                    shorter[piece] = piece[:end]
                    break
        return matcher, shorter

    def _cut(self) -> re.Pattern:
        """Splits escaped text where no piece can reach across: before a space, around line ends."""
        long = [p for p in self.ids if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in long):
            return re.compile(r"(?s).+")
        if any("\n" in p for p in long):
            return re.compile(f"(?s){SPACE}*[^{SPACE}]+|{SPACE}+")
        return re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")

    def compatible(self, left: str, right: str) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merge(left + right) == [left, right]
        return known

    def _known(self, text: str) -> list[int]:
        """Encodes a text all of whose characters are pieces."""
        ids, longest = self.ids, self.matcher.iter_long
        size, at, chosen = len(text), 0, []
        open_at = bytearray(b"\x01") * (size + 1)
        pairs, shorter = self.pairs, self.shorter
        piece = next(longest(text))[1]
        while at < size:
            before = chosen[-1] if chosen else None
            while piece is not None:
                end = at + len(piece)
                if open_at[end]:
                    fits = True if before is None else pairs.get((before, piece))
                    if fits is None:
                        fits = self.compatible(before, piece)
                    if fits:
                        break
                piece = shorter.get(piece)
            if piece is None:
                open_at[at] = 0
                if before is None:
                    raise ValueError("no encoding exists")
                at -= len(before)
                piece = chosen.pop()
            else:
                chosen.append(piece)
                at = end
                piece = next(longest(text, at))[1] if at < size else None
        return [ids[p] for p in chosen]

    def encode_chunk(self, chunk: str) -> list[int]:
        if self.characters.issuperset(chunk):
            return self._known(chunk)
        out, run = [], []
        for c in chunk:
            if c in self.characters:
                run.append(c)
                continue
            if run:
                out += self._known("".join(run))
                run = []
            out += [self.byte_ids[b] for b in c.encode("utf-8")]
        return out + self._known("".join(run)) if run else out

    def chunks(self, text: str) -> list[str]:
        return self.cut.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def decode(self, ids: list[int]) -> str:
        try:
            text = "".join(map(self.surface.__getitem__, ids))
        except TypeError:
            return self._decode_runs(ids)
        for i in ids:
            if self.kinds[i] != CONTROL:
                return text[1:] if self.names[i][0] == SPACE else text
        return text

    def _decode_runs(self, ids: list[int]) -> str:
        """Decoding with runs of bytes that make characters together, or unknown pieces."""
        out, run, first = [], bytearray(), True
        for i in ids:
            kind = self.kinds[i]
            if kind == BYTE:
                run.append(self.bytes_of[i])
                continue
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()
                first = False
            if kind == CONTROL:
                continue
            if kind == UNKNOWN:
                out.append(" ⁇ ")
            else:
                name = self.names[i]
                out.append((name[1:] if first and name[0] == SPACE else name).replace(SPACE, " "))
            first = False
        if run:
            out.append(_utf8(bytes(run)))
        return "".join(out)


def _utf8(data: bytes) -> str:
    """Characters of ``data``; every byte outside a whole character becomes U+FFFD."""
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(data):
            for size in (1, 2, 3, 4):
                try:
                    out.append(data[at : at + size].decode("utf-8"))
                    at += size
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


def load_model(path: str) -> PieceModel:
    return held("pieces", ("model", path), lambda: PieceModel(path))


def _memo(path: str) -> WordMemo:
    model = load_model(path)
    return held(
        "pieces",
        ("words", path),
        lambda: WordMemo(lambda words: (array("i", model.encode_chunk(w)).tobytes() for w in words)),
    )


def encode_pieces(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = 2
) -> DataFrame:
    """``id_col, ids array<int>`` for every row, ``end_id`` last unless it is None."""
    tail = b"" if end_id is None else np.array([end_id], "<i4").tobytes()

    def encode(batches):
        model, memo = load_model(model_path), _memo(model_path)
        for batch, texts in text_slices(batches, "text"):
            data = memo.joined([model.chunks(t) if t else [] for t in texts])
            ids = list_array([np.frombuffer(d + tail, "<i4") for d in data], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("id"), ids], ["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(encode, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode_pieces(encoded: DataFrame, model_path: str, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """The rows of ``encoded`` with the text of their ids in column ``into``, replacing one of that name."""
    kept = [c for c in encoded.columns if c != into]

    def decode(batches):
        model = load_model(model_path)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                column = part.column(ids_col)
                flat, at = column.flatten().to_numpy(zero_copy_only=False).tolist(), 0
                texts = []
                for size in column.value_lengths().fill_null(0).to_pylist():
                    texts.append(model.decode(flat[at : at + size]))
                    at += size
                texts = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], [*kept, into])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name != into)
    return encoded.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(decode, f"{schema}, `{into}` string")
