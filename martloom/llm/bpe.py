"""Byte-level BPE by a transducer that is made deterministic as texts need it.

The encoding of a piece is the only sequence of tokens in which every two neighbours,
encoded together by the merges, give just those two tokens. So the last token of every
prefix is fixed. A transducer reads bytes; its state is the bytes in which a token may
still start and the last token at each of their borders, and a move gives the token that
ends with the byte read. Tokens before the last border that all open sequences share are
settled and emitted; how far that lies back is bounded by the longest token. States and
moves are made when first needed and shared by all pieces.

Decoding is a stream: token bytes go through a UTF-8 state machine that holds back an
unfinished character until the next tokens complete it.

Defined results: a null or empty text has no tokens; equal rows give equal rows; an
unknown id raises; bytes that are not UTF-8 become U+FFFD in decoded text and stay as
they are in decoded bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.rows import WORKER_TABLES, map_columns

#: Memory of one task, not results: past these sizes the tables start anew.
MAX_STATES, MAX_PIECES, PIECE_CHARS = 200_000, 200_000, 48
TABLES = "bpe"
#: Bytes of one piece after which settled tokens are emitted.
LONG_PIECE = 4096


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Lines of base64 token and rank."""
    return {base64.b64decode(t): int(n) for t, n in map(bytes.split, raw.splitlines()) if t}


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {n: t for t, n in ranks.items()}
        self.width = {n: len(t) for t, n in ranks.items()}
        self.number = {n: n for n in ranks.values()}  # one object per id, whoever holds it
        self.heads = {b""} | {t[:i] for t in ranks for i in range(1, len(t))}
        self._pairs: dict[int, bool] = {}
        self._whole: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        # A state: the bytes a token may still start in, and the last token at each of
        # their borders (-1: the start of the piece).
        self._states: list[tuple[bytes, tuple[int, ...]]] = [(b"", (-1,))]
        self._numbers = {self._states[0]: 0}
        # state << 8 | byte -> state << 24 | token that ends here
        self._moves: dict[int, int] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The definition: merge the neighbours of least rank until none is a token."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            least, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if least == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _reachable(self, token: int) -> bool:
        if token not in self._whole:
            self._whole[token] = self.merge(self.tokens[token]) == [token]
        return self._whole[token]

    def _neighbours(self, x: int, y: int) -> bool:
        key = x << 24 | y
        found = self._pairs.get(key)
        if found is None:
            if len(self._pairs) > 2 * MAX_STATES:
                self._pairs.clear()
            found = self._pairs[key] = self.merge(self.tokens[x] + self.tokens[y]) == [x, y]
        return found

    def _move(self, number: int, byte: int) -> int:
        suffix, lasts = self._states[number]
        read = suffix + bytes([byte])
        for k, last in enumerate(lasts):  # the longest token first
            token = self.ranks.get(read[k:])
            if token is not None and self._reachable(token) and (last < 0 or self._neighbours(last, token)):
                break
        else:
            raise ValueError(f"no token for byte {byte}")
        keep = 0
        while read[keep:] not in self.heads:
            keep += 1
        key = (read[keep:], (*lasts[keep:], token))
        to = self._numbers.get(key)
        if to is None:
            to = self._numbers[key] = len(self._states)
            self._states.append(key)
        self._moves[number << 8 | byte] = move = to << 24 | token
        return move

    def _path(self, ends: list[int], stop: int) -> list[int]:
        """The tokens of the first ``stop`` bytes."""
        out = []
        while stop:
            token = ends[stop - 1]
            out.append(self.number[token])
            stop -= self.width[token]
        out.reverse()
        return out

    def _settled(self, ends: list[int], state: int) -> int:
        """The last border through which every open token sequence passes."""
        borders = {len(ends) - k for k in range(len(self._states[state][1]))}
        while len(borders) > 1:
            last = max(borders)
            borders.remove(last)
            borders.add(last - self.width[ends[last - 1]])
        return borders.pop()

    def encode(self, piece: bytes) -> list[int]:
        if len(self._states) > MAX_STATES:
            self._reset()
        out: list[int] = []
        moves, state, ends = self._moves, 0, []
        for at in range(0, len(piece), LONG_PIECE):
            for byte in piece[at:at + LONG_PIECE]:
                move = moves.get(state << 8 | byte)
                if move is None:
                    move = self._move(state, byte)
                ends.append(move & 0xFFFFFF)
                state = move >> 24
            if at + LONG_PIECE < len(piece):
                settled = self._settled(ends, state)
                out += self._path(ends, settled)
                ends = ends[settled:]
        out += self._path(ends, len(ends))
        return out


class Encoder:
    """Splits a text by ``pattern`` and encodes each match by itself."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer = Transducer(ranks)
        self.split = regex.compile(pattern).findall
        # Pieces met lately and those met before them; the older half is dropped in turn.
        self._known: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        if not text:
            return out
        known, older, encode = self._known, self._older, self.transducer.encode
        for piece in self.split(text):
            ids = known.get(piece)
            if ids is None:
                ids = older.get(piece)
                if ids is None:
                    ids = tuple(encode(piece.encode()))
                if len(piece) <= PIECE_CHARS:
                    if len(known) >= MAX_PIECES:
                        self._older, self._known = older, known = known, {}
                    known[piece] = ids
            out += ids
        return out


# UTF-8 by the Unicode standard, table 3-7 (first byte, second byte, more bytes).
_UTF8 = [(0x00, 0x7F, None, 0), (0xC2, 0xDF, (0x80, 0xBF), 0), (0xE0, 0xE0, (0xA0, 0xBF), 1),
         (0xE1, 0xEC, (0x80, 0xBF), 1), (0xED, 0xED, (0x80, 0x9F), 1), (0xEE, 0xEF, (0x80, 0xBF), 1),
         (0xF0, 0xF0, (0x90, 0xBF), 2), (0xF1, 0xF3, (0x80, 0xBF), 2), (0xF4, 0xF4, (0x80, 0x8F), 2)]


_RUNS = re.compile(rb"[\x00-\x7f]+|[\x80-\xff]+")


class Utf8Stream:
    """Text of byte chunks as they come; an unfinished character waits for its rest. Runs of
    ASCII stay in the starting state, so they are taken whole."""

    def __init__(self) -> None:
        self.held = b""
        # (low, high) of the next byte, and how many more follow it
        self.expects: tuple[int, int, int] | None = None

    def feed(self, chunk: bytes) -> str:
        if not self.held and chunk.isascii():
            return chunk.decode("ascii")
        out: list[str] = []
        done = bytearray()
        for run in _RUNS.findall(chunk):
            if run[0] < 0x80 and self.expects is None:
                done += run
            else:
                done = self._step(run, done, out)
        return "".join(out) + done.decode()

    def _step(self, run: bytes, done: bytearray, out: list[str]) -> bytearray:
        for byte in run:
            if self.expects is not None:
                low, high, more = self.expects
                if low <= byte <= high:
                    self.held += bytes([byte])
                    self.expects = (0x80, 0xBF, more - 1) if more else None
                    if not more:
                        done += self.held
                        self.held = b""
                    continue
                out.append(done.decode() + "�")
                done, self.held, self.expects = bytearray(), b"", None
            for low, high, second, more in _UTF8:
                if low <= byte <= high:
                    if second is None:
                        done.append(byte)
                    else:
                        self.held, self.expects = bytes([byte]), (*second, more)
                    break
            else:
                out.append(done.decode() + "�")
                done = bytearray()
        return done

    def close(self) -> str:
        left, self.held, self.expects = self.held, b"", None
        return "�" if left else ""


class Decoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.bytes_of = {n: t for t, n in ranks.items()}.__getitem__

    def chunks(self, ids: Iterable[int], size: int = 4096) -> Iterator[bytes]:
        ids = list(ids)
        for at in range(0, len(ids), size):
            yield b"".join(map(self.bytes_of, ids[at:at + size]))

    def text(self, ids: Iterable[int]) -> str:
        stream = Utf8Stream()
        return "".join([stream.feed(c) for c in self.chunks(ids)] + [stream.close()])


def _coders(raw: bytes, pattern: str) -> tuple[Encoder, Decoder]:
    """One pair per vocabulary and worker, so that states are shared by its tasks."""
    key = hashlib.sha256(raw + pattern.encode()).hexdigest()
    held = WORKER_TABLES.get(TABLES)
    if held is None or held[0] != key:
        ranks = read_ranks(raw)
        held = WORKER_TABLES[TABLES] = key, (Encoder(ranks, pattern), Decoder(ranks))
    return held[1]


def _vocabulary(df: DataFrame, path: str):
    """The rank file, under a megabyte, read on the driver and sent to every executor."""
    with open(path, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids) for every row."""
    raw = _vocabulary(docs, path)

    def make():
        encoder = _coders(raw.value, pattern)[0]
        return lambda keys, texts: (keys, [encoder.encode(t) for t in texts])

    keyed = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return map_columns(keyed, ["doc_id", "text"], [("doc_id", "long"), ("ids", "array<int>")], make, keeps=TABLES)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    raw = _vocabulary(encoded, path)

    def make():
        decoder = _coders(raw.value, pattern)[1]
        return lambda keys, ids: (keys, [decoder.text(x or ()) for x in ids])

    return map_columns(encoded, ["doc_id", "ids"], [("doc_id", "long"), ("text", "string")], make, keeps=TABLES)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for every row, in one pass: ids
    are encoded, then decoded again as a stream."""
    raw = _vocabulary(docs, path)

    def make():
        encoder, decoder = _coders(raw.value, pattern)
        digits = {n: str(n) for n in encoder.transducer.tokens}.__getitem__

        def work(keys, texts):
            counts, ids_sha, text_sha = [], [], []
            for t in texts:
                ids = encoder.encode(t)
                decoded, stream = hashlib.sha256(), Utf8Stream()
                for chunk in decoder.chunks(ids):
                    decoded.update(stream.feed(chunk).encode())
                decoded.update(stream.close().encode())
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join(map(digits, ids)).encode()).hexdigest())
                text_sha.append(decoded.hexdigest())
            return keys, counts, ids_sha, text_sha

        return work

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_columns(keyed, ["doc_id", "text"],
                       [("doc_id", "long"), ("n_tokens", "long"), ("ids_sha256", "string"),
                        ("decoded_sha256", "string")], make, keeps=TABLES)


def encoded_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids, intact) for every row; intact: decoding the ids
    as a stream gives the text again."""
    raw = _vocabulary(docs, path)

    def make():
        encoder, decoder = _coders(raw.value, pattern)

        def work(keys, sources, texts):
            ids = [encoder.encode(t) for t in texts]
            return (keys, sources, list(map(len, ids)), ids,
                    [decoder.text(x) == (t or "") for x, t in zip(ids, texts, strict=True)])

        return work

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text")
    return map_columns(keyed, ["doc_id", "source", "text"],
                       [("doc_id", "long"), ("source", "string"), ("n_tokens", "long"), ("ids", "array<int>"),
                        ("intact", "boolean")], make, keeps=TABLES)
