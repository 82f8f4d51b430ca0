"""Byte-level BPE by a lazily determinised finite-state transducer (operator 6).

The nondeterministic transducer: a state is (last token written, bytes read since). Reading a
byte extends the bytes, which must begin some vocabulary entry; where they are an entry that may
follow the last token, that token may be written. Two tokens may follow each other if merging
their joined bytes by rank gives back just the two, and a sequence is the encoding of its bytes if
and only if all its neighbours may follow each other; so exactly one path is left at any end of input,
and every byte position has one encoding of what lies before it.

Determinised, a state is the set of those paths: for each of the last positions at which a token may
still be open, what has been written up to there and the open bytes. What all paths have written alike is
emitted at once, and the rest waits; a token has a greatest length, so the lookahead is bounded. States
and transitions are made when met OFTEN, or in a long piece at once, and are dropped together when there are more than
STATES. Where a short piece leaves the transitions made, its paths are followed to its end without making states of them:
most are of one word only, and a state costs more than the word.

Decoding runs an incremental UTF-8 state machine over the tokens' bytes, which gives characters out as soon
as they are whole, whatever the chunks; its moves over a whole token are kept.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from struct import pack

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATES, PIECES, FEW = 160_000, 1_000_000, 2
#: A transition is made when it is asked for so often; until then pieces of up to SHORT bytes go on by the paths of the state.
OFTEN, SHORT = 8, 64


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a .tiktoken file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Plain BPE of a short piece: the pair of least rank is merged, the first of equals, until none can be."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min(((ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks), default=None)
        if best is None:
            break
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
    return [ranks[p] for p in parts]


class Transducer:
    """Deterministic states, made lazily: number -> {byte: (number, tokens emitted)}; final outputs by number."""

    def __init__(self, ranks: dict[bytes, int], states: int | None = None):
        self.ranks, self.states = ranks, states or STATES
        self.tokens = {r: b for b, r in ranks.items()}
        #: Beginnings of entries: the rank of those that are entries themselves, else -1.
        self.begins = {b[:k]: -1 for b in ranks for k in range(1, len(b) + 1)} | ranks
        self.entries = sorted(ranks)
        self.sound: dict[int, bool] = {}
        self.edges: tuple[dict, dict] = ({}, {})
        self.follows: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        # A path is (the last token written or -1, open bytes); it has a number, and moves[number << 8 | byte] is
        # [number of the path grown by byte or -1, token or -1 that its bytes then are, its path or -1, -2: not looked into].
        self.path_number: dict[tuple[int, bytes], int] = {(-1, b""): 0}
        self.path_list: list[tuple[int, bytes]] = [(-1, b"")]
        self.moves: dict[int, list[int]] = {}
        # A state: for each path, tokens written but not emitted; and the paths.
        start = (((),), (0,))
        self.paths, self.number, self.next, self.end = [start], {start: 0}, [{}], [()]
        self.asked: dict[int, int] = {}

    def _path(self, last: int, opened: bytes) -> int:
        at = self.path_number.setdefault((last, opened), len(self.path_list))
        if at == len(self.path_list):
            self.path_list.append((last, opened))
        return at

    def _move(self, path: int, byte: int) -> list[int]:
        last, opened = self.path_list[path]
        entry = opened + bytes((byte,))
        token = self.begins.get(entry)
        if token is None or not self._alive(last, entry):
            out = [-1, -1, -1]
        else:
            out = [self._path(last, entry), token, -2 if token >= 0 else -1]
        self.moves[path << 8 | byte] = out
        return out

    def _alive(self, last: int, opened: bytes) -> bool:
        """False only if no entry that begins with the open bytes may follow the last token; looks into FEW entries at most."""
        low = bisect_left(self.entries, opened)
        few = self.entries[low : low + FEW + 1]
        for entry in few:
            if not entry.startswith(opened):
                return False
            if self._may_follow(last, self.ranks[entry]):
                return True
        return len(few) > FEW

    def _edge(self, token: int, right: bool) -> list[tuple[bytes, float]]:
        """How a token's outermost part at one side grows: (bytes, rank at which it is merged into the next)."""
        known = self.edges[right]
        if token not in known:
            out: list[tuple[bytes, float]] = []
            part, ends = self.tokens[token], float("inf")
            while True:
                out.append((part, ends))
                if len(part) == 1:
                    break
                ends = self.ranks[part]
                part = self._halves(part)[right]
            known[token] = out[::-1]
        return known[token]

    def _halves(self, entry: bytes) -> tuple[bytes, bytes]:
        """The two parts of the last merge of an entry."""
        others = {b: r for b, r in ((entry[i:j], self.ranks.get(entry[i:j])) for i in range(len(entry)) for j in range(i + 1, len(entry) + 1)) if r is not None and b != entry}
        left = self.tokens[merge(entry, others)[0]]
        return left, entry[len(left) :]

    def _is_sound(self, token: int) -> bool:
        """Whether the merges of an entry's bytes give the entry."""
        if token not in self.sound:
            self.sound[token] = merge(self.tokens[token], self.ranks) == [token]
        return self.sound[token]

    def _may_follow(self, last: int, token: int) -> bool:
        """Whether merging the bytes of both gives both: at no rank do the parts that meet at the border merge.

        The parts on either side grow at known ranks; a pair across the border goes first if its rank is less
        than that of the merge to its left, or not more than that of the merge to its right.
        """
        if last < 0:
            return self._is_sound(token)
        key = last << 32 | token
        known = self.follows.get(key)
        if known is None:
            if len(self.follows) >= 8 * self.states:
                self.follows.clear()
            known = self._is_sound(token) and self._apart(self._edge(last, True), self._edge(token, False))
            self.follows[key] = known
        return known

    def _apart(self, xs: list[tuple[bytes, float]], ys: list[tuple[bytes, float]]) -> bool:
        i = j = 0
        ranks = self.ranks
        while True:
            (x, x_ends), (y, y_ends) = xs[i], ys[j]
            rank = ranks.get(x + y)
            if rank is not None and rank < x_ends and rank <= y_ends:
                return False
            if x_ends <= y_ends:
                i += 1
                if i == len(xs):
                    return True
            else:
                j += 1

    def step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The transition, worked out by following all paths."""
        moves, writes, paths, whole = self.moves, [], [], -1
        for written, path in zip(*self.paths[state]):
            move = moves.get(path << 8 | byte) or self._move(path, byte)
            if move[0] < 0:
                continue
            if move[1] >= 0 and whole < 0:
                if move[2] == -2:
                    move[2] = self._path(move[1], b"") if self._may_follow(self.path_list[path][0], move[1]) else -1
                if move[2] >= 0:  # the one encoding of all bytes so far
                    whole, last = move[2], (*written, move[1])
            writes.append(written)
            paths.append(move[0])
        if whole < 0:
            raise ValueError(f"no vocabulary entry ends at byte {byte}")
        writes.append(last)
        paths.append(whole)
        out = writes[0]
        if out:
            for written in writes:
                if written[: len(out)] != out:
                    shared = 0
                    while shared < min(len(out), len(written)) and written[shared] == out[shared]:
                        shared += 1
                    out = out[:shared]
            if out:
                n = len(out)
                writes = [w[n:] for w in writes]
        key = (tuple(writes), tuple(paths))
        at = self.number.get(key)
        if at is None:
            at = self.number[key] = len(self.paths)
            self.paths.append(key)
            self.next.append({})
            self.end.append(writes[-1])
        self.next[state][byte] = (at, out)
        return at, out

    def _by_paths(self, state: int, piece: bytes, at: int) -> list[int]:
        """Tokens not yet emitted of a piece of which the bytes before ``at`` led to a state: all paths are followed, no state is made."""
        begins, follows = self.begins, self.follows
        # For each open path: where its open bytes begin, its last token, and what it has written.
        open_ = []
        for written, path in zip(*self.paths[state]):
            last, opened = self.path_list[path]
            open_.append((at - len(opened), last, written))
        for end in range(at + 1, len(piece) + 1):
            left, whole = [], None
            for path in open_:
                token = begins.get(piece[path[0] : end])
                if token is None:
                    continue
                left.append(path)
                if token >= 0 and whole is None:
                    follow = follows.get(path[1] << 32 | token)
                    if self._may_follow(path[1], token) if follow is None else follow:
                        whole = (end, token, (*path[2], token))
            if whole is None:
                raise ValueError(f"no vocabulary entry ends at byte {piece[end - 1]}")
            left.append(whole)
            open_ = left
        return list(open_[-1][2])

    def _only(self, state: int) -> int:
        """Forgets all states and paths but one state, and gives its new number."""
        writes, paths = self.paths[state]
        held = [self.path_list[p] for p in paths]
        self._reset()
        key = (writes, tuple(self._path(*p) for p in held))
        if key in self.number:
            return 0
        self.number[key] = 1
        self.paths.append(key)
        self.next.append({})
        self.end.append(writes[-1])
        return 1

    def encode(self, piece: bytes) -> list[int]:
        """Tokens of one piece; a piece that is an entry of the vocabulary is that token."""
        token = self.ranks.get(piece)
        if token is not None:
            return [token]
        if len(self.paths) > self.states or len(self.moves) > 4 * self.states or len(self.asked) > 4 * self.states:
            self._reset()
        out: list[int] = []
        at, moves, short = 0, self.next, len(piece) <= SHORT
        for k, byte in enumerate(piece):
            hit = moves[at].get(byte)
            if hit is None:
                if short:
                    key = at << 8 | byte
                    asked = self.asked[key] = self.asked.get(key, 0) + 1
                    if asked < OFTEN:
                        return out + self._by_paths(at, piece, k)
                hit = self.step(at, byte)
                if len(self.paths) > 2 * self.states or len(self.moves) > 8 * self.states:  # a very long piece: keep only where it stands
                    hit, moves = (self._only(hit[0]), hit[1]), self.next
            at, emitted = hit
            if emitted:
                out += emitted
        out += self.end[at]
        return out


#: Between characters: no byte needed, nothing read, any next byte (bytes needed, code point so far, least and greatest next byte).
START = (0, 0, 0x80, 0xBF)


def _lead(byte: int) -> tuple[int, int, int, int] | None:
    """The state after a byte that begins a longer character; None for bytes that begin none."""
    if 0xC2 <= byte <= 0xDF:
        return 1, byte & 0x1F, 0x80, 0xBF
    if 0xE0 <= byte <= 0xEF:  # no overlong forms, no surrogates
        return 2, byte & 0x0F, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF
    if 0xF0 <= byte <= 0xF4:  # no overlong forms, nothing above U+10FFFF
        return 3, byte & 0x07, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
    return None


class Utf8Stream:
    """Incremental UTF-8 state machine: bytes in any chunks, whole characters out, a state of four numbers between them.

    A character that goes wrong becomes U+FFFD where it does, and the byte that broke it is read anew.
    """

    def __init__(self, state: tuple[int, int, int, int] = START) -> None:
        self.state = state

    def feed(self, chunk: bytes, last: bool = False) -> str:
        """Characters that this chunk completes."""
        out = []
        need, value, low, high = self.state
        for byte in chunk:
            if need:
                if low <= byte <= high:
                    need, value, low, high = need - 1, value << 6 | byte & 0x3F, 0x80, 0xBF
                    if not need:
                        out.append(chr(value))
                    continue
                out.append("\ufffd")
                need = 0
            if byte < 0x80:
                out.append(chr(byte))
            elif (state := _lead(byte)) is None:
                out.append("\ufffd")
            else:
                need, value, low, high = state
        if need and last:
            out.append("\ufffd")
            need = 0
        self.state = (need, value, low, high) if need else START
        return "".join(out)


#: What keeps a text from being looked up by parts: white space side by side, ASCII and other white space (fixed values).
_TIGHT = ("  ", "\n\n", " \n", "\n ", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f")
_BLANKS = ("\x85", "\xa0", "\u1680", *map(chr, range(0x2000, 0x200B)), "\u2028", "\u2029", "\u202f", "\u205f", "\u3000")
_ENDS = (" ", "\n")


class Codec:
    """Encodes and decodes whole texts with one vocabulary and one pattern of pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, states: int | None = None, pieces: int | None = None):
        self.fst, self.most = Transducer(ranks, states), pieces or PIECES
        self.pattern, self.by_parts = regex.compile(pattern), pattern == public_tokenizers.PATTERN
        self.spaced, self.first, self.pieces = _Known(self, b" "), _Known(self, b""), {}
        self.newline, self.marks = self.ids_of("\n"), {m: self.ids_of(m) for m in ".,"}
        self.steps: dict[tuple, dict[int, tuple]] = {}
        self.learned = 0
        #: Characters of tokens that are whole characters by themselves; None for others.
        self.whole: list[str | None] = [None] * (max(self.fst.tokens, default=-1) + 1)
        for token, raw in self.fst.tokens.items():
            stream = Utf8Stream()
            text = stream.feed(raw)
            if stream.state == START:
                self.whole[token] = text

    def ids_of(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers, each match of the pattern encoded separately."""
        out = []
        for piece in self.pattern.findall(text):
            raw = piece.encode()
            if (ids := self.pieces.get(raw)) is None:
                if 4 * len(self.pieces) >= self.most:
                    self.pieces.clear()
                ids = pack(f"<{len(found := self.fst.encode(raw))}I", *found)
                if len(raw) <= 64:
                    self.pieces[raw] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text.

        Where all white space is single blanks and line feeds, no match crosses the place before a blank or
        around a line feed, so parts between these are looked up by themselves; other texts are matched whole,
        and so are all texts where the pattern is another than the one this holds for.
        """
        if not self.by_parts or any(map(text.__contains__, _TIGHT)) or text[:1] in _ENDS or text[-1:] in _ENDS or (not text.isascii() and any(map(text.__contains__, _BLANKS))):
            return self.ids_of(text)
        lines = []
        for line in text.split("\n"):
            head, *rest = line.split(" ")
            lines.append(self.first[head] + b"".join(map(self.spaced.__getitem__, rest)))
        return self.newline.join(lines)

    def decode(self, ids: bytes, chunk: int = 4096) -> Iterator[str]:
        """The text of ids, a chunk of tokens at a time.

        The state machine's moves over the bytes of a token are kept by (state, token), so that a token met again is one look-up;
        a chunk of tokens that all are whole characters leaves the state as it is.
        """
        numbers, state = np.frombuffer(ids, "<u4").tolist(), START
        moves = self.steps.setdefault(START, {})
        for k in range(0, len(numbers), chunk):
            out, part = [], numbers[k : k + chunk]
            if state == START:  # most chunks stay between characters
                out = list(map(self.whole.__getitem__, part))
                if None not in out:
                    yield "".join(out)
                    continue
                out = []
            for token in part:
                text, after = moves.get(token) or self._move(state, token)
                out.append(text)
                if after != state:
                    state, moves = after, self.steps.setdefault(after, {})
            yield "".join(out)
        if state != START:
            yield Utf8Stream(state).feed(b"", True)

    def _move(self, state: tuple, token: int) -> tuple[str, tuple]:
        """The characters that a token completes in a state, and the state after it."""
        if self.learned > 4 * len(self.fst.tokens):
            self.steps.clear()
            self.learned = 0
        stream = Utf8Stream(state)
        move = stream.feed(self.fst.tokens[token]), stream.state
        self.steps.setdefault(state, {})[token] = move
        self.learned += 1
        return move


class _Known(dict):
    """Ids of a part of a text after a given beginning, for a given number of parts at most.

    When half of them are here, they become the older half, from which parts that are met again come back.
    """

    def __init__(self, codec: Codec, before: bytes):
        super().__init__()
        self.codec, self.before, self.older = codec, before.decode(), {}

    def __missing__(self, part: str) -> bytes:
        if (ids := self.older.get(part)) is not None:
            self[part] = ids
            return ids
        code = self.codec
        if part[-1:] in (".", ",") and len(part) > 1 and part[:-1].isalpha():  # a match ends before the mark
            return self[part[:-1]] + code.marks[part[-1]]
        if part.isalpha() and (part.isascii() or max(part) < "\u2000"):  # one match
            ids = pack(f"<{len(out := code.fst.encode((self.before + part).encode()))}I", *out)
        else:
            ids = code.ids_of(self.before + part)
        if len(part) <= 64:
            if 2 * len(self) >= code.most:
                self.older = dict(self)
                self.clear()
            self[part] = ids
        return ids


_CODECS: dict[tuple, Codec] = {}


def codec(path: str, pattern: str, states: int | None = None, pieces: int | None = None) -> Codec:
    """The codec of a rank file, one a process."""
    key = (path, pattern, states, pieces)
    if key not in _CODECS:
        _CODECS[key] = Codec(read_ranks(path), pattern, states, pieces)
    return _CODECS[key]


def encode(docs: DataFrame, path: str, pattern: str, with_ids: bool = True, states: int | None = None, pieces: int | None = None) -> DataFrame:
    """docs (doc_id, text) as doc_id, n_tokens, ids (array of ints, on request), ids_sha256 and decoded_sha256.

    Null texts count as empty: no ids. The decoded text is what the ids give back, as UTF-8. Rows repeat as in docs.
    states and pieces bound what a worker remembers (about 0.5 GB by default); they change its speed only.
    """
    fields = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def one(code: Codec, text: str | None) -> list:
        ids = code.encode(text or "")
        back = hashlib.sha256()
        for part in code.decode(ids):
            back.update(part.encode())
        return [len(ids) // 4, hashlib.sha256(ids).hexdigest(), back.hexdigest(), *([np.frombuffer(ids, "<i4")] if with_ids else [])]

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path, pattern, states, pieces)
        for whole in batches:
            for b in (whole.slice(k, 128) for k in range(0, whole.num_rows, 128)):
                columns = list(zip(*(one(code, t) for t in b.column(1).to_pylist()))) or [[]] * (3 + with_ids)
                kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(list(c), k) for c, k in zip(columns, kinds))], names=[x.split()[0] for x in fields.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(each, fields)
