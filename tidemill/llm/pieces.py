"""SentencePiece encoding and decoding as shortest paths through a weighted transducer."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain, groupby, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import map_batches, with_id, worker_store

SPACE = "▁"
# Fixed values of the model file format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
_KEEP = 100_000  # spellings a worker remembers; the worker shares an executor with as many others as it has cores
_PART = 1_000_000  # characters encoded at a time
_WINDOW = 6  # characters that mostly decide which pieces start at a place


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of each field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            size = varint()
            yield key >> 3, data[at:at + size]
            at += size
        elif kind == 5:
            yield key >> 3, struct.unpack("<f", data[at:at + 4])[0]
            at += 4
        elif kind == 1:
            yield key >> 3, struct.unpack("<d", data[at:at + 8])[0]
            at += 8
        else:
            raise ValueError("not a model file")


class Remembered:
    """Spellings and their ids, the latest ones: two generations of bounded size."""

    def __init__(self):
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def put(self, unit: str, ids: tuple[int, ...]) -> None:
        if len(self.young) >= _KEEP:
            self.old, self.young = self.young, {}
        self.young[unit] = ids

    def older(self, unit: str) -> tuple[int, ...] | None:
        ids = self.old.get(unit)
        if ids is not None:
            self.put(unit, ids)
        return ids


class Transducer:
    """Normaliser, pieces and byte fallback of a model, compiled once and composed with each input.

    * The normaliser maps a space to U+2581 and puts one in front of a text.
    * The piece machine is a trie over code points; an accepting state emits
      the piece's id.  A character that no piece covers goes through the byte
      arcs instead.
    * Weights live in the tropical semiring (min, +).  In a unigram model an
      arc weighs minus its piece's score.  In a BPE model, whose scores are
      merge ranks, path sums of scores would not give the merges' result; there
      the state also remembers the last piece, and following it with another
      weighs 0 if merging their joint spelling yields just these two, else
      infinity.  Merging goes by rank and then place, so a path all of whose
      neighbours agree is the one that merging gives, and it is the only path
      of finite weight: the shortest path is the model's encoding.

    Only identity normalisers are compiled (no character map in the model).
    """

    def __init__(self, model: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.type, self.prefix, self.squeeze, self.escape, self.fallback = UNIGRAM, True, True, True, False
        for number, value in _fields(model):
            if number == 1:
                got = dict(_fields(value))
                self.pieces.append(got.get(1, b"").decode("utf-8"))
                self.scores.append(got.get(2, 0.0))
                self.kinds.append(got.get(3, NORMAL))
            elif number == 2:
                got = dict(_fields(value))
                self.type, self.fallback = got.get(3, UNIGRAM), bool(got.get(35, 0))
            elif number == 3:
                got = dict(_fields(value))
                if got.get(2):
                    raise ValueError("only identity normalisers are compiled")
                self.prefix, self.squeeze, self.escape = (bool(got.get(k, 1)) for k in (3, 4, 5))
        if self.type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are compiled")
        if self.squeeze or not self.escape:
            raise ValueError("only models that keep and escape spaces are compiled")
        self.unknown = self.kinds.index(UNKNOWN)
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        self.own = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == USER}
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}
        self.rank = {p: self.scores[i] for p, i in self.ids.items()}
        self.worst = min(self.rank.values(), default=0.0) - 10.0
        # The piece machine: nested states by character; "" leads to the piece that ends there.
        self.start: dict = {}
        for piece in self.ids:
            state = self.start
            for c in piece:
                state = state.setdefault(c, {})
            state[""] = piece
        inner = re.compile(f"[^{SPACE}]{SPACE}")
        if any(inner.search(p) for p in self.ids):
            raise ValueError("pieces that go on past a space are not compiled")
        # Places that no piece spans: before a space after other characters, next to a lone
        # character, and between two characters that are neighbours in no piece.  A text may
        # be cut there and the parts composed apart.
        joined = {c for p in self.ids if len(p) > 1 for c in p}
        lone = "".join(re.escape(c) for c in "\n\t\r" if c not in joined)
        self.cut = re.compile((f"[{lone}]|" if lone else "") + f"{SPACE}*[^{SPACE}{lone}]+|{SPACE}+")
        self.pairs = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.users = re.compile("|".join(map(re.escape, sorted(self.own, key=len, reverse=True)))) if self.own else None
        # Ids that stand for their own spelling, ASCII bytes among them.
        self.plain = {i: p for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k in (NORMAL, USER)}
        self.plain |= {i: chr(b) for b, i in self.bytes.items() if b < 128}
        self.shown = np.array([self.plain.get(i) for i in range(len(self.pieces))], dtype=object)
        self.known = Remembered()
        self.near: dict[str, tuple[str, ...]] = {}
        self.agree: dict[str | None, dict[str, bool]] = {}
        self.agreed = 0

    # Normaliser

    def normalise(self, text: str) -> str:
        line = text.replace(" ", SPACE)
        return SPACE + line if self.prefix and line else line

    # Weights of a BPE model

    def merged(self, spelling: str) -> list[str]:
        """Pieces that merging by rank, then place, leaves of a spelling."""
        parts, rank = list(spelling), self.rank
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r > best):
                    best, at = r, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, a: str | None, b: str) -> bool:
        """Whether ``b`` may come after ``a`` (None: at the start)."""
        after = self.agree.get(a)
        if after is None:
            after = self.agree[a] = {}
        ok = after.get(b)
        if ok is None:
            ok = self.merged((a or "") + b) == ([a, b] if a else [b])
            self.agreed += 1
            if self.agreed >= _KEEP:
                self.agree.clear()
                self.agreed = 0
            else:
                after[b] = ok
        return ok

    # Composition and shortest path

    def arcs(self, unit: str, at: int) -> tuple[str, ...]:
        """Pieces that start at ``at``, the longest first; a character without a piece stands for its bytes."""
        window = unit[at:at + _WINDOW]
        found = self.near.get(window)
        if found is not None:
            return found
        out, state, far = [], self.start, False
        for c in islice(unit, at, None):
            state = state.get(c)
            if state is None:
                break
            piece = state.get("")
            if piece is not None:
                out.append(piece)
        else:
            far = len(window) == _WINDOW
        if not out or len(out[0]) > 1:
            out.insert(0, unit[at])
        found = tuple(out[::-1])
        # What the window alone decides is remembered.
        if not far and len(found[0]) < _WINDOW and self._leaves(window):
            if len(self.near) >= _KEEP:
                self.near = {}
            self.near[window] = found
        return found

    def _leaves(self, window: str) -> bool:
        """Whether the piece machine has come to an end within the window, or the unit has."""
        state = self.start
        for c in window:
            state = state.get(c)
            if state is None:
                return True
        return len(window) < _WINDOW

    def shortest(self, unit: str) -> list[str]:
        """Pieces on the shortest path of the transducer composed with ``unit``."""
        return self._only(unit) if self.type == BPE else self._least(unit)

    def _only(self, unit: str) -> list[str]:
        """The one path of finite weight, depth first, longest arcs first.

        A path of weight 0 to a place is the encoding of the text before it, so
        each place is reached one way only, and one left without a way on is dead.
        """
        n, path, dead = len(unit), [], set()
        at, last, ways, agree = 0, None, [iter(self.arcs(unit, 0))], self.agree
        while at < n:
            for s in ways[-1]:
                if at + len(s) in dead:
                    continue
                after = agree.get(last)
                ok = after.get(s) if after else None
                if self.follows(last, s) if ok is None else ok:
                    path.append(s)
                    at += len(s)
                    last = s
                    if at < n:
                        ways.append(iter(self.arcs(unit, at)))
                    break
            else:
                dead.add(at)
                ways.pop()
                at -= len(path.pop())
                last = path[-1] if path else None
        return path

    def _least(self, unit: str) -> list[str]:
        """The path of least weight, place by place."""
        n = len(unit)
        weight, came = [0.0] + [float("inf")] * n, [""] * (n + 1)
        for i in range(n):
            for s in self.arcs(unit, i):
                w = weight[i] - self.rank.get(s, self.worst)
                if w < weight[i + len(s)]:
                    weight[i + len(s)], came[i + len(s)] = w, s
        path, at = [], n
        while at:
            path.append(came[at])
            at -= len(came[at])
        return path[::-1]

    def output(self, pieces: list[str]) -> tuple[int, ...]:
        out: list[int] = []
        for p in pieces:
            i = self.ids.get(p)
            if i is not None:
                out.append(i)
            elif self.fallback:
                out.extend(self.bytes[b] for b in p.encode("utf-8", "surrogatepass"))
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)  # neighbours that are unknown are one
        return tuple(out)

    def unit(self, unit: str) -> tuple[int, ...]:
        at = len(unit)
        while at > 2 and unit[at - 2:at] not in self.pairs:
            at -= 1  # a final mark that no piece joins to what is before it
        known = self.known
        if at < len(unit):
            front = unit[:at]
            before, marks = known.young.get(front) or known.older(front) or self.unit(front), self.output(list(unit[at:]))
            return before + (marks[1:] if not self.fallback and before[-1] == marks[0] == self.unknown else marks)
        ids = self.output(self.shortest(unit))
        if len(unit) <= 64:
            known.put(unit, ids)
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of a text; of an empty text none."""
        out: list[int] = []
        line = self.normalise(text)
        known, take, extend = self.known, self.unit, out.extend
        at = 0
        spans = [*self.users.finditer(line)] if self.users else []
        for own in [*spans, None]:
            stop = own.start() if own else len(line)
            for u in self.cut.findall(line[at:stop] if spans else line):
                extend(known.young.get(u) or known.older(u) or take(u))
            if own:
                out.append(self.own[own.group()])
                at = own.end()
        return out

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each has.

        The units of all texts are told apart first, so that each different
        one is composed or looked up once.
        """
        if self.users:
            found = [self.encode(t) for t in texts]
            return np.fromiter(chain.from_iterable(found), dtype=np.int32), np.array([len(x) for x in found], dtype=np.int64)
        units: list[str] = []
        ends = np.zeros(len(texts) + 1, dtype=np.int64)
        for k, text in enumerate(texts):
            units += self.cut.findall(self.normalise(text))
            ends[k + 1] = len(units)
        coded = pa.array(units, pa.string()).dictionary_encode()
        del units
        at, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        take = self.unit
        found = [self.known.young.get(u) or self.known.older(u) or take(u) for u in words]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        flat = np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(sizes.sum()))
        first = np.cumsum(sizes) - sizes
        each = sizes[at]
        before = np.concatenate(([0], np.cumsum(each)))
        ids = flat[np.repeat(first[at] - before[:-1], each) + np.arange(before[-1])]
        return ids, before[ends[1:]] - before[ends[:-1]]

    def spelling(self, ids: tuple[int, ...]) -> str:
        """Pieces and bytes of ids, joined."""
        parts = [self.plain.get(i) for i in ids]
        if None not in parts:
            return "".join(parts)
        parts = []
        for byte, run in groupby(ids, lambda i: self.kinds[i] == BYTE):
            if byte:
                parts.append(bytes(int(self.pieces[i][3:5], 16) for i in run).decode("utf-8", "replace"))
            else:
                parts += [" \u2047 " if self.kinds[i] == UNKNOWN else "" if self.kinds[i] == CONTROL else self.pieces[i] for i in run]
        return "".join(parts)

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces joined, byte runs read as UTF-8 (bad bytes become U+FFFD), the front space taken off."""
        return next(self.decode_many(np.array(ids, dtype=np.int64), [0, len(ids)]))

    def decode_many(self, ids: np.ndarray, ends: Sequence[int]) -> Iterator[str]:
        """Texts of the ids between neighbouring ``ends``."""
        pieces = self.shown[ids].tolist()
        for a, b in zip(ends[:-1], ends[1:]):
            try:
                yield self._line("".join(pieces[a:b]))
            except TypeError:  # a byte, a control mark or an unknown is among them
                yield self._line(self.spelling(tuple(ids[a:b].tolist())))

    def _line(self, line: str) -> str:
        if self.prefix and line.startswith(SPACE):
            line = line[1:]
        return line.replace(SPACE, " ")


def load(model_file: str) -> Transducer:
    with open(model_file, "rb") as f:
        return Transducer(f.read())


def _compiled(model: bytes) -> Transducer:
    """The worker's transducer of a model, compiled once per worker."""
    store, key = worker_store("pieces"), zlib.crc32(model)
    if key not in store:
        store.clear()
        store[key] = Transducer(model)
    return store[key]


def encode_texts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, round_trip) for every row: one pass over whole texts, no shuffle.

    ``model_file`` is read on the driver and goes to the workers as a broadcast
    of its own size.  ``round_trip`` says whether the ids, decoded, give the text back;
    a text that itself holds U+2581 cannot come back.  A null text has null ids
    and round_trip; an empty text has no ids and comes back.
    """
    with open(model_file, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batch: pa.RecordBatch, t: Transducer) -> Iterator[pa.RecordBatch]:
        sizes = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        step = np.cumsum(sizes) // _PART
        for part in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(step)) + 1):
            ids_of, texts = (batch.column(k).slice(int(part[0]), len(part)) for k in (0, 1))
            gone = np.array(texts.is_null(), dtype=bool)
            plain = [x or "" for x in texts.to_pylist()]
            ids, each = t.encode_many(plain)
            ends = np.concatenate(([0], np.cumsum(each))).astype(np.int32)
            back = np.fromiter(map(str.__eq__, t.decode_many(ids, ends), plain), dtype=bool, count=len(plain))
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids), mask=pa.array(gone))
            yield pa.RecordBatch.from_arrays([ids_of, lists, pa.array(back, pa.bool_(), mask=gone)], ["id", "ids", "round_trip"])

    named = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return map_batches(named, run, with_id(named, "ids array<int>, round_trip boolean"), lambda: _compiled(shared.value))


def decode_ids(encoded: DataFrame, model_file: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, text) from ids; null ids give a null text, no ids an empty one."""
    with open(model_file, "rb") as f:
        shared = encoded.sparkSession.sparkContext.broadcast(f.read())

    def run(batch: pa.RecordBatch, t: Transducer) -> pa.RecordBatch:
        texts = [None if ids is None else t.decode(ids) for ids in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    named = encoded.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{ids_col}`").alias("ids"))
    return map_batches(named, run, with_id(named, "text string"), lambda: _compiled(shared.value))
