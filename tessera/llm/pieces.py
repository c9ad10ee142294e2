"""SentencePiece encoding and decoding over a given vocabulary, as a unigram model.

An Aho-Corasick automaton of all pieces reads a text once; at each position its output links give the pieces
that end there, and each relaxes the best score of that position (Viterbi).  Characters without a piece fall
back to byte pieces.  The lattice falls apart where no piece can cross, before a word mark that follows other
characters, so segments are encoded once and remembered (a bounded memory); if some piece does cross such a
place, texts are encoded whole.  Nothing is trained: the model file is a parameter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import Rolling, blocks

MARK = "▁"
UNKNOWN_PENALTY = 10.0
DENSE = 0x180  #: characters below it go through the dense table
LONG = 64  #: longer segments go through the automaton one by one


def default_model() -> str:
    """The public vocabulary that the environment offers."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _text(code: np.ndarray) -> str:
    return code.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... of each run of the given sizes, one after the other."""
    total = np.cumsum(size)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(start - (total - size), size)


class Table:
    """The automaton as a table over a dense alphabet (characters below DENSE and the mark), with each state's
    output links flattened: the pieces that end there, longest first.  Many segments go through it at once."""

    def __init__(self, pieces: list[tuple[str, float, int]], fallback: float):
        self.fallback = fallback
        letters = sorted({c for t, _, _ in pieces for c in t} | {MARK})
        self.letter = np.zeros(DENSE + 1, np.int32)  # 0: no piece has it
        for n, c in enumerate(letters, 1):
            self.letter[min(ord(c), DENSE)] = n
        self.letter[ord(" ")] = self.letter[DENSE]
        child: dict[tuple[int, int], int] = {}
        depth, own = [0], {}
        for text, score, number in pieces:
            state = 0
            for c in text:
                key = (state, int(self.letter[min(ord(c), DENSE)]))
                if key not in child:
                    child[key] = len(depth)
                    depth.append(depth[state] + 1)
                state = child[key]
            own[state] = (len(text), score, number)
        states = len(depth)
        self.goto = np.zeros((states, len(letters) + 1), np.int32)
        fail = np.zeros(states, np.int32)
        edges = np.array([(a, c, b) for (a, c), b in child.items()], np.int64).reshape(-1, 3)
        level = np.array(depth)[edges[:, 0]]
        outputs: list[tuple] = [()] * states
        deep = np.array(depth)
        for d in range(max(depth) + 1):
            a, c, b = edges[level == d].T
            if d:
                nodes = np.flatnonzero(deep == d)
                self.goto[nodes] = self.goto[fail[nodes]]
                fail[b] = self.goto[a, c]
            self.goto[a, c] = b
            for x in b.tolist():
                outputs[x] = ((own[x],) if x in own else ()) + outputs[fail[x]]
        count = np.array([len(o) for o in outputs], np.int64)
        self.first, self.count = np.cumsum(count) - count, count
        every = [o for out in outputs for o in out]
        self.out_size = np.array([o[0] for o in every], np.int64)
        self.out_score = np.array([o[1] for o in every], np.float64)
        self.out_id = np.array([o[2] for o in every], np.int32)
        self.lone = np.ones(len(letters) + 1, bool)
        for text, _, _ in pieces:
            if len(text) == 1:
                self.lone[self.letter[min(ord(text), DENSE)]] = False

    def viterbi(self, code: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all segments one after the other, sizes); -1 - c stands for a character c without a piece.
        Segments are spans of ``code``, code points."""
        size = np.zeros(len(start), np.int64)
        parts, places = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for n in np.unique(length).tolist():
            some = np.flatnonzero(length == n)
            for at in range(0, len(some), 32768):
                pick = some[at : at + 32768]
                flat, own = self._same_length(code[start[pick][:, None] + np.arange(n)].astype(np.int64), n, len(pick))
                parts.append(flat)
                places.append(np.repeat(pick, own))
                size[pick] = own
        return np.concatenate(parts)[np.argsort(np.concatenate(places), kind="stable")], size

    def _same_length(self, code: np.ndarray, n: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
        letter = self.letter[code].T.copy()
        best = np.full((n + 1, rows), -np.inf)
        best[0] = 0
        origin = np.zeros((n + 1, rows), np.int8)
        number = np.zeros((n + 1, rows), np.int32)
        state = np.zeros(rows, np.int32)
        for t in range(1, n + 1):
            state = self.goto[state, letter[t - 1]]
            top, step, which = best[t], origin[t], number[t]
            lone = np.flatnonzero(self.lone[letter[t - 1]])
            if len(lone):
                top[lone], step[lone], which[lone] = best[t - 1, lone] + self.fallback, 1, -1 - code[lone, t - 1]
            left = np.flatnonzero(self.count[state])
            place = self.first[state[left]]
            end = place + self.count[state[left]]
            while len(left):
                reached = best[t - self.out_size[place], left] + self.out_score[place]
                better = reached > top[left]
                who, what = left[better], place[better]
                top[who], step[who], which[who] = reached[better], self.out_size[what], self.out_id[what]
                place = place + 1
                more = place < end
                left, place, end = left[more], place[more], end[more]
        at = np.full(rows, n)
        every = np.arange(rows)
        ids = np.zeros((n, rows), np.int32)
        used = np.zeros(rows, np.int64)
        alive = every
        while len(alive):
            ids[n - 1 - used[alive], alive] = number[at[alive], alive]
            used[alive] += 1
            at[alive] -= origin[at[alive], alive]
            alive = alive[at[alive] > 0]
        keep = np.arange(n)[:, None] >= n - used
        return ids.T[keep.T], used


class Pieces:
    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece

        source = sentencepiece.SentencePieceProcessor()
        source.LoadFromSerializedProto(model)
        size = source.get_piece_size()
        self.text = [source.id_to_piece(i) for i in range(size)]
        special = [source.is_control(i) or source.is_unknown(i) or source.is_unused(i) for i in range(size)]
        self.byte: dict[int, int] = {i: int(self.text[i][3:5], 16) for i in range(size) if source.is_byte(i)}
        self.of_byte = {b: i for i, b in self.byte.items()}
        self.unknown = source.unk_id()
        self.special = {i for i in range(size) if special[i]}
        self.automaton = ahocorasick.Automaton()
        lowest = 0.0
        self.single: set[str] = set()
        crossing = re.compile(f"[^{MARK}]{MARK}")
        self.cut = True
        for i in range(size):
            piece = self.text[i]
            if special[i] or i in self.byte or not piece:
                continue
            score = source.get_score(i)
            lowest = min(lowest, score)
            self.automaton.add_word(piece, (len(piece), score, i))
            if len(piece) == 1:
                self.single.add(piece)
            self.cut = self.cut and not crossing.search(piece)
        self.automaton.make_automaton()
        self.fallback = lowest - UNKNOWN_PENALTY
        self.raw = [bytes([self.byte[i]]) if i in self.byte else b"" if special[i] else self.text[i].replace(MARK, " ").encode() for i in range(size)]
        self.table = Table([(t, s, i) for t, s, i in self._scored(source) if all(ord(c) < DENSE or c == MARK for c in t)], self.fallback)

    def _scored(self, source) -> Iterator[tuple[str, float, int]]:
        for i, piece in enumerate(self.text):
            if i not in self.special and i not in self.byte and piece:
                yield piece, source.get_score(i), i

    def viterbi(self, segment: str) -> list[int]:
        """Ids of the best segmentation; among equal ones, that of the earliest starts."""
        n = len(segment)
        best = [0.0] + [-np.inf] * n
        start_of, id_of = [0] * (n + 1), [-1] * (n + 1)
        lone = [i for i, c in enumerate(segment) if c not in self.single]
        lone.reverse()
        for end, (length, score, number) in self.automaton.iter(segment):
            # Fallbacks that end before or at this end come first: their starts are earlier positions.
            while lone and lone[-1] <= end - length:
                i = lone.pop()
                if best[i] + self.fallback > best[i + 1]:
                    best[i + 1], start_of[i + 1], id_of[i + 1] = best[i] + self.fallback, i, -1
            at = end + 1
            reached = best[at - length] + score
            if reached > best[at]:
                best[at], start_of[at], id_of[at] = reached, at - length, number
        while lone:
            i = lone.pop()
            if best[i] + self.fallback > best[i + 1]:
                best[i + 1], start_of[i + 1], id_of[i + 1] = best[i] + self.fallback, i, -1
        ids: list[int] = []
        at = n
        while at:
            if id_of[at] >= 0:
                ids.append(id_of[at])
            else:
                raw = segment[start_of[at] : at].encode("utf-8", "surrogatepass")
                ids.extend(self.of_byte.get(b, self.unknown) for b in reversed(raw))
            at = start_of[at]
        ids.reverse()
        return ids

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text; a leading space is added, spaces become word marks.  Empty or null: none."""
        return self.encode_all([text])[0].tolist()

    def _distinct(self, code: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct segments one after the other, and their sizes."""
        length = stop - start
        plain = length <= LONG
        high = np.concatenate([[0], np.cumsum(code >= DENSE)])
        plain &= high[stop] == high[start]
        size = np.zeros(len(start), np.int64)
        flat, size[plain] = self.table.viterbi(code, start[plain], length[plain])
        owner = np.repeat(np.flatnonzero(plain), size[plain])
        odd = np.flatnonzero(~plain)
        rare = [np.array(self.viterbi(_text(code[start[i] : stop[i]]).replace(" ", MARK)), np.int32) for i in odd.tolist()]
        size[odd] = [len(r) for r in rare]
        fallen = np.flatnonzero(flat < 0)
        if len(fallen):  # single characters without a piece: their bytes
            raw = [[self.of_byte.get(b, self.unknown) for b in chr(-1 - c).encode()] for c in flat[fallen].tolist()]
            more = np.ones(len(flat), np.int64)
            more[fallen] = [len(r) for r in raw]
            first = (np.cumsum(more) - more)[fallen]
            flat, owner = np.repeat(flat, more), np.repeat(owner, more)
            for at, ids in zip(first.tolist(), raw, strict=True):
                flat[at : at + len(ids)] = ids
            size[plain] = np.bincount(owner, minlength=len(start))[plain]
        flat = np.concatenate([flat, *rare])
        owner = np.concatenate([owner, np.repeat(odd, size[odd])])
        return flat[np.argsort(owner, kind="stable")], size

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; equal segments are encoded once."""
        if not self.cut:
            return [np.array(self.viterbi(MARK + t.replace(" ", MARK)) if t else [], np.int32) for t in texts]
        marked = ["" if not t else " " + t.replace(MARK, " ") for t in texts]
        code = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([0, *map(len, marked)])
        space = code == 32
        first = space & ~np.concatenate([[False], space[:-1]]) if len(code) else space
        first[ends[:-1][np.diff(ends) > 0]] = True
        start = np.flatnonzero(first)
        stop = np.concatenate([start[1:], [len(code)]]) if len(start) else start
        _, some, inverse = np.unique(Rolling(code).spans(start, stop), return_index=True, return_inverse=True)
        flat, size = self._distinct(code, start[some], stop[some])
        ids = flat[spread((np.cumsum(size) - size)[inverse], size[inverse])]
        cut = np.concatenate([[0], np.cumsum(size[inverse])])[np.searchsorted(start, ends)]
        return [ids[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]

    def plain_bytes(self, ids: np.ndarray) -> bytes:
        """The bytes of ids' pieces, marks as spaces."""
        if not hasattr(self, "_raw"):
            size = np.array([len(r) for r in self.raw], np.int64)
            self._raw = np.frombuffer(b"".join(self.raw), np.uint8), np.cumsum(size) - size, size
        data, start, size = self._raw
        return data[spread(start[ids], size[ids])].tobytes()

    def decode(self, ids: list[int]) -> str:
        """The text of ids; control ids vanish, unknown ones show as U+2047, marks become spaces, and the
        leading space that encoding added goes.  Texts with neither the mark itself nor half surrogates come back exactly."""
        byte, text = self.byte, self.text
        if byte.keys().isdisjoint(ids) and self.special.isdisjoint(ids):
            joined = "".join([text[i] for i in ids])
        else:
            parts = [
                bytes([byte[i]]) if i in byte else b"" if i in self.special and i != self.unknown else "⁇".encode() if i == self.unknown else text[i].encode()
                for i in ids
            ]
            joined = b"".join(parts).decode("utf-8", "replace")
        joined = joined.replace(MARK, " ")
        return joined[1:] if joined.startswith(" ") else joined


def _model_bytes(docs: DataFrame, model: str | None) -> bytes:
    with open(model or default_model(), "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, model: str | None = None) -> DataFrame:
    """docs' rows with ids (array of int), n_pieces and round_trip (decoding the ids gives the text back).

    ``model``: path of a SentencePiece model on the driver; its bytes (of fixed size) go with the tasks.
    Null and empty texts have no ids and round_trip true.  Long texts are encoded whole; a text that holds the
    mark U+2581 itself decodes to spaces there, and round_trip says false.  Rows repeat as they do; older
    columns of these names are replaced, others pass through.
    """
    docs = docs.select(*[c for c in docs.columns if c.lower() not in ("ids", "n_pieces", "round_trip")])
    shared = docs.sparkSession.sparkContext.broadcast(_model_bytes(docs, model))
    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_pieces", T.IntegerType()), T.StructField("round_trip", T.BooleanType())])
    at_text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(shared.value)
        for whole in batches:
            for at, n in blocks(whole.column(at_text)):
                batch = whole.slice(at, n)
                texts = batch.column(at_text).to_pylist()
                flat = pieces.encode_all(texts)
                good = [pieces.plain_bytes(i)[1:] == (t or "").encode("utf-8", "surrogatepass") for i, t in zip(flat, texts, strict=True)]
                size = [0, *map(len, flat)]
                offsets = np.cumsum(size).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(flat)))
                yield pa.RecordBatch.from_arrays([*batch.columns, ids, pa.array(np.array(size[1:], np.int32)), pa.array(good)], names=schema.names)

    return docs.mapInArrow(run, schema)


def decode_documents(rows: DataFrame, model: str | None = None, ids: str = "ids") -> DataFrame:
    """rows with ``decoded``: the text of each row's ids; null ids give null."""
    rows = rows.select(*[c for c in rows.columns if c.lower() != "decoded"])
    shared = rows.sparkSession.sparkContext.broadcast(_model_bytes(rows, model))
    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())])
    at = rows.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(shared.value)
        for batch in batches:
            texts = [None if x is None else pieces.decode(x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)


def op1_pieces(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode_documents(docs).select("doc_id", "n_pieces", "ids", "round_trip")
