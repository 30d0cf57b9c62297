"""Byte-level BPE as a lazily determinised finite-state transducer.

A sequence of tokens is the encoding of its bytes exactly if every two
neighbours are *compatible*: merging the bytes of the two alone gives the two
back. So of the readings that a non-deterministic transducer over the trie of
tokens guesses, one alone ends with compatible tokens at each position. The
trie is determinised by the subset construction: a state is the set of trie
nodes that are live, one for each place where a token may have begun. States
and transitions are built when first reached and then kept. Each position
records the token that ends there; its left neighbour is already known, as far
back as the longest token reaches. A token is emitted once every live reading
passes through it, so lookahead and memory do not grow with the piece.

Decoding joins the bytes of tokens and feeds them to an incremental UTF-8 state
machine, so that text can be streamed token by token.

Defined results: a null text is the empty text and gives no ids; ids may be
empty; an unknown id raises ``ValueError``; columns of the same name as an
output column are replaced.
"""

from __future__ import annotations

import base64
from array import array
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame, types as T
from pyspark.sql import functions as F

from .common import add_columns

#: Bounds of what a worker keeps: transitions, compatible pairs, encoded pieces.
MAX_TRANSITIONS, MAX_PAIRS, MAX_PIECES = 500_000, 400_000, 180_000
#: Pieces longer than this are encoded anew each time, so kept pieces stay small.
LONGEST_KEPT = 64
#: Bytes that a piece may have open before settled tokens are emitted.
SETTLE_AFTER = 192
#: Above every rank.
NEVER = 1 << 40


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


class BpeTransducer:
    """Encoder compiled from ranks; feed it whole pieces."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self._child: dict[int, int] = {}
        self._token: list[int] = [-1]
        self._depth: list[int] = [0]
        self._size = {rank: len(token) for token, rank in ranks.items()}
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                key = node << 8 | byte
                node = self._child.get(key) or self._grow(key)
            self._token[node] = rank
        self.forget()

    def _grow(self, key: int) -> int:
        self._child[key] = node = len(self._token)
        self._token.append(-1)
        self._depth.append(self._depth[key >> 8] + 1)
        return node

    def forget(self) -> None:
        """Forget all states; they are built again when reached."""
        self._ids: dict[tuple[int, ...], _State] = {}
        self._follows: dict[int, _Follows] = {}
        self._edges: dict[int, tuple | None] = {}
        self.transitions = self.pairs = 0
        self._start = self._state((0,))

    def _state(self, nodes: tuple[int, ...]) -> _State:
        found = self._ids.get(nodes)
        if found is None:
            found = self._ids[nodes] = _State(self, nodes)
        return found

    def _spines(self, token: int) -> tuple | None:
        """What stands at both ends of ``token`` while it is merged from its bytes.

        For each end the parts, outermost last, as (bytes, rank at which the part
        appears, rank at which it is merged further). None if merging the token's
        bytes does not give the token.
        """
        if token in self._edges:
            return self._edges[token]
        own = self.bytes_of[token]
        parts = [own[i : i + 1] for i in range(len(own))]
        first, last = [(parts[0], -1)], [(parts[-1], -1)]
        while len(parts) > 1:
            pairs = [self.ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
            best = min(pairs)
            if best == NEVER:
                self._edges[token] = None
                return None
            at = pairs.index(best)
            if at == 0:
                first.append((parts[0] + parts[1], best))
            if at == len(parts) - 2:
                last.append((parts[-2] + parts[-1], best))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        spans = tuple(
            [(x, born, spine[i + 1][1] if i + 1 < len(spine) else NEVER) for i, (x, born) in enumerate(spine)]
            for spine in (first, last)
        )
        self._edges[token] = spans
        return spans

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both gives both (left -1: begins a piece).

        It does unless two parts that meet at the border at the same time can be
        merged before either is merged into its own token; of equal ranks the
        leftmost is merged first.
        """
        after = self._spines(right)
        if after is None or left < 0:
            return after is not None
        before, ranks = self._spines(left), self.ranks
        for a, born_a, gone_a in before[1]:
            for b, born_b, gone_b in after[0]:
                if born_a < gone_b and born_b < gone_a:
                    joint = ranks.get(a + b)
                    if joint is not None and joint < gone_a and joint <= gone_b:
                        return False
        return True

    def step(self, nodes: tuple[int, ...], byte: int) -> tuple[_State, tuple]:
        """Determinise one transition: the next state and, of each token that may end, (token, length, what it may follow)."""
        self.transitions += 1
        live = [c for n in nodes if (c := self._child.get(n << 8 | byte)) is not None]
        tokens = [t for c in live if (t := self._token[c]) >= 0]
        for t in tokens:
            if t not in self._follows:
                self._follows[t] = _Follows(self, t)
        return self._state((*live, 0)), tuple((t, self._size[t], self._follows[t]) for t in tokens)

    def _settle(self, nodes: tuple[int, ...], last: list[int], out: list[int]) -> None:
        """Emit the tokens on which all live readings agree and forget them."""
        at = {len(last) - 1 - self._depth[n] for n in nodes}
        while len(at) > 1:
            furthest = max(at)
            at.remove(furthest)
            at.add(furthest - len(self.bytes_of[last[furthest]]))
        border = at.pop()
        if border > 0:
            self._emit(last, border, out)
            last[:border] = []

    def _emit(self, last: list[int], end: int, out: list[int]) -> None:
        """Append the tokens of the first ``end`` bytes, found from their last one backwards."""
        start = len(out)
        while end > 0:
            token = last[end]
            out.append(token)
            end -= self._size[token]
        out[start:] = out[: start - 1 if start else None : -1]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the splitting pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if self.transitions >= MAX_TRANSITIONS or self.pairs >= MAX_PAIRS:
            self.forget()
        out: list[int] = []
        last = [-1]  # by bytes read since the last token emitted: the token that ends there
        state = self._start
        for start in range(0, len(piece), SETTLE_AFTER):
            for byte in piece[start : start + SETTLE_AFTER]:
                state, ends = state[byte]
                for token, size, follows in ends:
                    if follows[last[-size]]:
                        last.append(token)
                        break
                else:
                    raise ValueError("the ranks do not cover every byte")
            if start + SETTLE_AFTER < len(piece):
                self._settle(state.nodes, last, out)
        self._emit(last, len(last) - 1, out)
        return out


class _State(dict):
    """A set of live trie nodes; as a dict, its transitions by byte."""

    __slots__ = ("machine", "nodes")

    def __init__(self, machine: BpeTransducer, nodes: tuple[int, ...]):
        self.machine, self.nodes = machine, nodes

    def __missing__(self, byte: int):
        found = self[byte] = self.machine.step(self.nodes, byte)
        return found


class _Follows(dict):
    """Whether a token may stand behind another, by the other."""

    __slots__ = ("machine", "token")

    def __init__(self, machine: BpeTransducer, token: int):
        self.machine, self.token = machine, token

    def __missing__(self, left: int) -> bool:
        self.machine.pairs += 1
        found = self[left] = self.machine.compatible(left, self.token)
        return found


class Encoder(dict):
    """Packed ids of texts. As a dict, what the transducer gave for a piece."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.transducer = BpeTransducer(ranks)
        self.split = regex.compile(pattern).findall

    def __missing__(self, piece: str) -> bytes:
        ids = self.transducer.encode_piece(piece.encode("utf-8", "replace"))
        packed = array("I", ids).tobytes()
        if len(piece) <= LONGEST_KEPT:
            self[piece] = packed
        return packed

    def forget(self) -> None:
        """Drop what has been gathered; the vocabulary stays."""
        self.clear()
        self.transducer.forget()

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if len(self) > MAX_PIECES:
            self.clear()
        return b"".join(map(self.__getitem__, self.split(text or "")))


class Utf8Machine:
    """Incremental UTF-8 decoder; ill-formed parts become U+FFFD each.

    The state is the number of bytes still needed, the range of the next one
    and the bits gathered; a broken sequence is replaced at its longest part
    that could have begun a character.
    """

    def __init__(self):
        self.need, self.low, self.high, self.bits = 0, 0x80, 0xBF, 0

    def feed(self, data: bytes) -> str:
        out = []
        for byte in data:
            if self.need:
                if self.low <= byte <= self.high:
                    self.bits = self.bits << 6 | byte & 0x3F
                    self.need -= 1
                    self.low, self.high = 0x80, 0xBF
                    if not self.need:
                        out.append(chr(self.bits))
                    continue
                out.append("�")
                self.need, self.low, self.high = 0, 0x80, 0xBF
            if byte < 0x80:
                out.append(chr(byte))
            elif 0xC2 <= byte <= 0xDF:
                self.need, self.bits = 1, byte & 0x1F
            elif 0xE0 <= byte <= 0xEF:
                self.need, self.bits = 2, byte & 0x0F
                self.low, self.high = 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF
            elif 0xF0 <= byte <= 0xF4:
                self.need, self.bits = 3, byte & 0x07
                self.low, self.high = 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
            else:
                out.append("�")
        return "".join(out)

    def finish(self) -> str:
        """What is left at the end of the input."""
        left = "�" if self.need else ""
        self.__init__()
        return left


class StreamDecoder:
    """Text of ids that arrive in any number of portions."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values(), default=-1) + 1
        self.bytes_of: list[bytes | None] = [None] * size
        self.text_of: list[str | None] = [None] * size
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
            machine = Utf8Machine()
            text = machine.feed(token)
            if not machine.need and "�" not in text:
                self.text_of[rank] = text  # from the start state back to it
        self.machine = Utf8Machine()

    def bytes(self, ids: np.ndarray) -> bytes:
        if len(ids) and int(ids.max()) >= len(self.bytes_of):
            raise ValueError("id outside the vocabulary")
        try:
            return b"".join([self.bytes_of[i] for i in ids.tolist()])
        except TypeError:
            raise ValueError("id outside the vocabulary") from None

    def feed(self, ids: np.ndarray) -> str:
        own = ids.tolist()
        if len(own) and max(own) >= len(self.bytes_of):
            raise ValueError("id outside the vocabulary")
        texts = [self.text_of[i] for i in own]
        if not self.machine.need and None not in texts:
            return "".join(texts)
        out, step = [], self.machine.feed
        for i, text in zip(own, texts):
            if text is not None and not self.machine.need:
                out.append(text)
            elif (token := self.bytes_of[i]) is None:
                raise ValueError("id outside the vocabulary")
            else:
                out.append(step(token))
        return "".join(out)

    def finish(self) -> str:
        return self.machine.finish()


@lru_cache(maxsize=2)
def _ranks(path: str) -> dict[bytes, int]:
    return load_ranks(path)


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(_ranks(path), pattern)


@lru_cache(maxsize=2)
def _decoder(path: str) -> StreamDecoder:
    return StreamDecoder(_ranks(path))


def _decoded(decoder: StreamDecoder, packed: bytes | None) -> str:
    return decoder.feed(np.frombuffer(packed or b"", "<u4")) + decoder.finish()


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids``: packed little-endian unsigned 32-bit ids of the whole text."""

    def make():
        encoder = _encoder(ranks_path, pattern)

        def work(texts):
            return {ids: [encoder.encode(x) for x in texts]}

        work.close = encoder.forget  # an idle worker keeps the vocabulary only
        return work

    return add_columns(df, make, text, **{ids: T.BinaryType()})


def round_trip(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add ``ids`` as ``encode`` does and ``decoded`` as ``decode`` does of them, in one pass with one vocabulary per worker."""

    def make():
        encoder, decoder = _encoder(ranks_path, pattern), _decoder(ranks_path)

        def work(texts):
            packed = [encoder.encode(x) for x in texts]
            return {ids: packed, decoded: [_decoded(decoder, x) for x in packed]}

        work.close = encoder.forget
        return work

    return add_columns(df, make, text, **{ids: T.BinaryType(), decoded: T.StringType()})


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add ``text``: what packed ids stand for, null ids giving the empty text."""

    def make():
        decoder = _decoder(ranks_path)

        def work(packed):
            return {text: [_decoded(decoder, x) for x in packed]}

        return work

    return add_columns(df, make, ids, **{text: T.StringType()})


def n_tokens(ids: str = "ids"):
    return (F.octet_length(F.col(ids)) / 4).cast("long")
