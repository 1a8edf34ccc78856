"""SentencePiece encoding and decoding as a shortest path through weighted transducers.

Three machines are compiled from a byte-pair model file and composed with each
text, arc by arc as the search reaches them:

* normaliser: one leading space is added to a text that is not empty, and every
  space becomes the sign U+2581; all else stays (the model's identity rule);
* pieces: one arc per vocabulary piece that matches at a place, and for a
  character that is no piece an arc of its UTF-8 bytes (byte fallback);
* merge order: an acceptor over neighbouring pieces. Its weight is 0 if the
  model's merges leave the two pieces apart and infinite if they do not. A path
  is a model segmentation exactly if all neighbours have weight 0.

The best path is the tropical-semiring minimum of the summed weights; only one
path has a finite weight. A space can only begin a piece (or stand
among spaces), and some control characters are in no piece at all, so a path
never crosses from another character to a space or past such a character: each
unit between two of these places is solved by itself, and the pieces of a unit
are kept for its next occurrence in the task (at most ``KEPT_UNITS``, in the
pipeline ``PIPELINE_UNITS``).

Every whole text is read once, in Arrow batches, without a shuffle. The model
file is read by the driver; its tables have the size of the vocabulary.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from .common import arrow_map, fresh, load, text_chunks, text_column

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
KEPT_UNITS = 600_000
PIPELINE_UNITS = 300_000  # the pipeline's executors also hold what its other stages left
KEPT_PAIRS = 250_000
SPACE = "▁"


@dataclass
class Vocabulary:
    """Tables of a model file: piece to (id, score), bytes of each id, ids of the 256 byte pieces."""

    pieces: dict[str, tuple[int, float]]
    spelled: list[bytes]
    byte_ids: list[int]
    breakers: str = field(default="")
    # compiled by a worker that encodes; it goes from there with the broadcast that it hangs on
    machine: Machine | None = field(default=None, repr=False, compare=False)

    @classmethod
    def read(cls, path: str = MODEL) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, spelled, byte_ids = {}, [], [-1] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                byte_ids[value] = i
                spelled.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                spelled.append(b"")
            else:
                pieces[piece] = (i, model.get_score(i))
                spelled.append(piece.replace(SPACE, " ").encode())
        if min(byte_ids) < 0:
            raise ValueError(f"{path} has no byte fallback")
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError(f"{path} has pieces with a space after another character")
        used = set().union(*map(set, pieces)) if pieces else set()
        breakers = "".join(chr(c) for c in range(32) if chr(c) not in used)
        return cls(pieces, spelled, byte_ids, breakers)


def normalise(text: str | None) -> str:
    """Output of the normaliser; empty for an empty or null text."""
    return SPACE + text.replace(" ", SPACE) if text else ""


class Machine:
    """The composed machines over units of normalised text."""

    def __init__(self, vocabulary: Vocabulary):
        # not the vocabulary, which may hold this machine: what nothing else refers to is freed at once
        self.known, self.byte_ids = vocabulary.pieces, vocabulary.byte_ids
        self.score = {p: s for p, (_, s) in vocabulary.pieces.items()}
        # most characters of a piece that begins with up to three given ones
        self.reach: dict[str, int] = {}
        for p in self.score:
            for k in range(1, min(len(p), 3) + 1):
                self.reach[p[:k]] = max(self.reach.get(p[:k], 0), len(p))
        stop = re.escape(vocabulary.breakers)
        self.unit = re.compile(f"{SPACE}*[^{SPACE}{stop}]+|{SPACE}+|[{stop}]" if stop else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.number = {p: i for i, p in enumerate(self.score)}
        self.bits = max(len(self.number), 1).bit_length()
        self.pairs: dict[int, bool] = {}  # by the numbers of both pieces

    def merged(self, text: str) -> list[str]:
        """What the model's merges make of a short string: again and again the neighbours whose
        union has the best score, the leftmost first."""
        score, none = self.score, -math.inf
        symbols = list(text)
        union = [score.get(a + b, none) for a, b in zip(symbols, symbols[1:], strict=False)]
        while union and (best := max(union)) > none:
            at = union.index(best)
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            del union[at]
            if at:
                union[at - 1] = score.get(symbols[at - 1] + symbols[at], none)
            if at < len(union):
                union[at] = score.get(symbols[at] + symbols[at + 1], none)
        return symbols

    def apart(self, left: str, right: str) -> bool:
        """Merge-order weight of two neighbours: 0 (true) or infinite (false)."""
        a, b = self.number.get(left, -1), self.number.get(right, -1)
        if a < 0 or b < 0:  # a character without a piece
            return self.merged(left + right) == [left, right]
        key = a << self.bits | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.merged(left + right) == [left, right]
        return known

    def shortest_path(self, unit: str) -> list[str]:
        """Pieces of the best path (a character without a piece stands for its bytes).

        Depth-first over the composed arcs, longest piece first; an arc of infinite weight is not taken, and
        a state (place, last piece) from which no path went on is not entered again. The merge-order acceptor
        leaves one path of finite weight, so the first complete path is the minimum."""
        number, pairs, reach, bits = self.number.get, self.pairs.get, self.reach.get, self.bits
        n = len(unit)
        path: list[str] = []
        dead: set[tuple[int, str]] = set()
        left, left_number, at = "", 0, 0
        size = min(reach(unit[:3], 2), n)
        while at < n:
            while size:
                arc = unit[at:at + size]
                arc_number = number(arc, -1)
                if arc_number >= 0 or size == 1:
                    if at:
                        open_ = pairs(left_number << bits | arc_number) if left_number >= 0 <= arc_number else None
                        if open_ is None:
                            open_ = self.apart(left, arc)
                    else:
                        open_ = True
                    if open_ and not (dead and (at + size, arc) in dead):
                        break
                size -= 1
            if size:
                path.append(arc)
                left, left_number = arc, arc_number
                at += size
                size = min(reach(unit[at:at + 3], 2), n - at)
            else:
                if not path:
                    raise ValueError(f"no path through {unit!r}")
                dead.add((at, left))
                arc = path.pop()
                at -= len(arc)
                left, size = path[-1] if path else "", len(arc) - 1
                left_number = number(left, -1)
        return path

    def ids(self, unit: str) -> tuple[int, ...]:
        out: list[int] = []
        for piece in self.shortest_path(unit):
            known = self.known.get(piece)
            if known is not None:
                out.append(known[0])
            else:
                out.extend(self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass"))
        return tuple(out)


class Codec(dict):
    """Encoder and decoder of one task: unit -> ids (32-bit numbers, as bytes), filled as units are met."""

    def __init__(self, vocabulary: Vocabulary, machine: Machine | None = None, kept: int | None = None):
        super().__init__()
        self.kept = KEPT_UNITS if kept is None else kept
        self.machine = machine or Machine(vocabulary)
        self.spelled = vocabulary.spelled

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= self.kept:
            self.clear()
        ids = self[unit] = array("i", self.machine.ids(unit)).tobytes()
        return ids

    def packed(self, text: str | None) -> array:
        return array("i", b"".join(map(self.__getitem__, self.machine.unit.findall(normalise(text)))))

    def encode(self, text: str | None) -> list[int]:
        return self.packed(text).tolist()

    def decode(self, ids: Sequence[int]) -> str:
        """Text of the ids without the space that the normaliser added; bytes that are no UTF-8 become U+FFFD."""
        out = b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "replace")
        return out[1:] if out.startswith(" ") else out


def _codec(shared, kept: int | None = None) -> Codec:
    """A codec for one task. Only the compiled machine outlives it in a reused worker, and only until the worker runs
    a task without this vocabulary: Spark takes the broadcast from it then, and nothing else holds the machine."""
    vocabulary = shared.value
    if vocabulary.machine is None:
        vocabulary.machine = Machine(vocabulary)
    return Codec(vocabulary, vocabulary.machine, kept)


_FIELDS = ["n_pieces", "pieces", "round_trip"]


def _encoded(texts: pa.Array, codec: Codec) -> list[pa.Array]:
    values, offsets, same = array("i"), [0], []
    for text in texts.to_pylist():
        ids = codec.packed(text)
        values.extend(ids)
        offsets.append(len(values))
        same.append(codec.decode(ids) == (text or "").replace(SPACE, " "))
    at = np.array(offsets, np.int32)
    pieces = pa.ListArray.from_arrays(pa.array(at), pa.array(np.frombuffer(values, np.int32), pa.int32()))
    return [pa.array(np.diff(at)), pieces, pa.array(same, pa.bool_())]


def encode(docs: DataFrame, vocabulary: Vocabulary, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns plus n_pieces, pieces (array of ids) and round_trip: whether decoding the ids
    gives the text again (the sign U+2581 itself reads as a space). Empty and null texts have no pieces.
    Repeated rows give repeated results; other columns of ``docs`` are ignored."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    keep = tuple(keep)
    carried = docs.select(*keep, *[c for c in ("text",) if c not in keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in text_chunks(batches):
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], *_encoded(batch.column("text"), codec)], [*keep, *_FIELDS])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return carried.transform(arrow_map, run, f"{schema}, n_pieces int, pieces array<int>, round_trip boolean")


def decode(rows: DataFrame, vocabulary: Vocabulary, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns plus the decoded text of ``pieces``; null pieces read as none."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)
    keep = tuple(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = [codec.decode(ids or []) for ids in part.column("pieces").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep], pa.array(texts, pa.string())], [*keep, "text"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema)
    return rows.select(*keep, "pieces").transform(arrow_map, run, f"{schema}, text string")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(load(spark, sf_dir, "documents"), Vocabulary.read())


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents with the ids of their pieces (columns of these names are replaced)."""
    shared, name = spark.sparkContext.broadcast(Vocabulary.read()), fresh(docs, "encoded")

    def encoder():
        codec = _codec(shared, PIPELINE_UNITS)
        return lambda texts: pa.StructArray.from_arrays(_encoded(texts, codec), _FIELDS)

    column = text_column(spark, encoder, "n_pieces int, pieces array<int>, round_trip boolean")
    keep = [c for c in docs.columns if c.lower() not in _FIELDS]
    return docs.withColumn(name, column("text")).select(*keep, f"{name}.*")
