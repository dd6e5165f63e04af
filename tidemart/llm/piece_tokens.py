"""Byte-pair encoding of public SentencePiece models, with offsets.

A text is normalised first: at each place the longest prefix that the model's
compiled character map knows is replaced, and for every byte of the result the
place of its source is recorded. Pieces are then merged in order of their scores,
and each is projected back to the bytes of the original text.
"""

from __future__ import annotations

import heapq
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from tidemart.llm.common import ship

SPACE = "▁"
_SPACE = SPACE.encode()
#: Letters after blanks, other characters after blanks, blanks at the end.
_RUNS = regex.compile(rf"{SPACE}*\p{{L}}+|{SPACE}*[^\p{{L}}{SPACE}]+|{SPACE}+")
_PARTS_KEPT = 600_000
_LONGEST_KEPT = 64
_NORMAL, _UNKNOWN, _BYTE = 1, 2, 6


class CharacterMap:
    """The compiled character map: a double-array trie over byte strings.

    Layout of the blob: the trie's size in bytes, the trie's units of 32 bits,
    then the replacements, each ended by a zero byte. A unit holds a label, the
    offset to its children, and whether a value ends there.
    """

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self._units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self._strings = blob[4 + size :]

    def longest(self, source: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest known prefix at a place."""
        units, found = self._units, None
        if not units:
            return None
        unit = units[0]
        node = unit >> 10 << ((unit & 0x200) >> 6)
        for i in range(at, len(source)):
            node ^= source[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != source[i]:
                break
            node ^= unit >> 10 << ((unit & 0x200) >> 6)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        end = self._strings.index(b"\0", found[1])
        return found[0], self._strings[found[1] : end]

    def __bool__(self) -> bool:
        return bool(self._units)


def _char_length(first: int) -> int:
    return 1 if first < 0xC0 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4


class Normalizer:
    """Normalises bytes of UTF-8 as a model's specification says."""

    def __init__(self, spec):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix = spec.add_dummy_prefix
        self.squeeze = spec.remove_extra_whitespaces
        if not spec.escape_whitespaces:
            raise ValueError("models that leave blanks unescaped are not supported")

    def __call__(self, source: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised bytes and, for each of them and the end, the source's place."""
        if self.map or self.squeeze:
            return self._by_prefixes(source)
        # Nothing but blanks changes: one byte becomes three.
        if not source:
            return b"", np.zeros(1, np.int64)
        raw = np.frombuffer(source, np.uint8)
        places = np.repeat(np.arange(len(raw)), np.where(raw == 0x20, 3, 1))
        places = np.append(places, len(raw))
        out = source.replace(b" ", _SPACE)
        if self.prefix:
            out, places = _SPACE + out, np.concatenate([np.zeros(3, np.int64), places])
        return out, places

    def _step(self, source: bytes, at: int) -> tuple[int, bytes]:
        found = self.map.longest(source, at) if self.map else None
        if found:
            return found
        n = _char_length(source[at])
        return n, source[at : at + n]

    def _by_prefixes(self, source: bytes) -> tuple[bytes, np.ndarray]:
        at, out, places = 0, bytearray(), []
        if self.squeeze:  # leading blanks go
            while at < len(source):
                n, new = self._step(source, at)
                if new != b" ":
                    break
                at += n
        if at == len(source):
            return b"", np.zeros(1, np.int64)
        if self.prefix:
            out += _SPACE
            places += [at] * 3
        after_blank = self.squeeze
        while at < len(source):
            n, new = self._step(source, at)
            if after_blank:
                new = new.lstrip(b" ")
            if new:
                escaped = new.replace(b" ", _SPACE)
                out += escaped
                places += [at] * len(escaped)
                after_blank = self.squeeze and new.endswith(b" ")
            at += n
        if self.squeeze:  # and trailing ones
            while out.endswith(_SPACE):
                del out[-3:]
                at = places[-3]
                del places[-3:]
        return bytes(out), np.array([*places, at], np.int64)


class PieceEncoder:
    """Encodes and decodes with the model of ``path``."""

    def __init__(self, path: str):
        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kinds = {p.type for p in model.pieces}
        if model.trainer_spec.model_type != 2 or kinds - {1, 2, 3, 6}:
            raise ValueError("only byte-pair models without user-defined pieces are supported")
        self.normalize = Normalizer(model.normalizer_spec)
        self.byte_fallback = model.trainer_spec.byte_fallback
        self.unknown = model.trainer_spec.unk_id
        self._ids, self._scores, self._surface = {}, {}, []
        self._bytes = [0] * 256
        for i, p in enumerate(model.pieces):
            if p.type == _BYTE:
                self._bytes[int(p.piece[3:5], 16)] = i
                self._surface.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type == _NORMAL:
                self._ids[p.piece], self._scores[p.piece] = i, p.score
                self._surface.append(p.piece.replace(SPACE, " ").encode())
            else:
                surface = model.trainer_spec.unk_surface if p.type == _UNKNOWN else ""
                self._surface.append(surface.encode())
        self._is_byte = [p.type == _BYTE for p in model.pieces]
        #: No piece is longer than a run, so a text can be merged run by run.
        self._by_runs = self.byte_fallback and all(map(_RUNS.fullmatch, self._ids))
        self._known: dict[str, bytes] = {}

    def _merge(self, text: str) -> list[str]:
        """The symbols left when pairs are merged, best score first, then leftmost."""
        scores, symbols = self._scores, list(text)
        if len(symbols) <= 48:
            pairs = [scores.get(a + b) for a, b in zip(symbols, symbols[1:], strict=False)]
            while True:
                best, where = None, -1
                for i, s in enumerate(pairs):
                    if s is not None and (best is None or s > best):
                        best, where = s, i
                if where < 0:
                    return symbols
                symbols[where : where + 2] = [symbols[where] + symbols[where + 1]]
                del pairs[where]
                if where < len(pairs):
                    pairs[where] = scores.get(symbols[where] + symbols[where + 1])
                if where:
                    pairs[where - 1] = scores.get(symbols[where - 1] + symbols[where])
        after = [*range(1, len(symbols)), -1]
        before = list(range(-1, len(symbols) - 1))
        heap = []

        def offer(i: int, j: int) -> None:
            both = symbols[i] + symbols[j]
            if both in scores:
                heapq.heappush(heap, (-scores[both], i, j, len(both)))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, size = heapq.heappop(heap)
            if not symbols[i] or not symbols[j] or len(symbols[i]) + len(symbols[j]) != size:
                continue
            symbols[i] += symbols[j]
            symbols[j] = ""
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
                offer(i, after[j])
            if before[i] >= 0:
                offer(before[i], i)
        return [s for s in symbols if s]

    def _part(self, text: str) -> bytes:
        """Of each piece of a normalised part the id and the bytes it covers, as 32-bit numbers."""
        ids, sizes = [], []
        for symbol in self._merge(text):
            number = self._ids.get(symbol)
            raw = symbol.encode()
            if number is not None:
                ids.append(number)
                sizes.append(len(raw))
            elif self.byte_fallback:
                ids += [self._bytes[b] for b in raw]
                sizes += [0] * (len(raw) - 1) + [len(raw)]  # the last byte carries the span
            elif ids and ids[-1] == self.unknown:
                sizes[-1] += len(raw)
            else:
                ids.append(self.unknown)
                sizes.append(len(raw))
        return np.array([ids, sizes], "<i4").T.tobytes()

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a text, and the byte of the original where each begins and ends.

        Of a character spelt in bytes the last id carries the span. NULL counts as
        empty and has no ids.
        """
        source = (text or "").encode("utf-8")
        normal, places = self.normalize(source)
        whole = normal.decode("utf-8", "replace")
        known, found = self._known, []
        if len(known) > _PARTS_KEPT:
            known.clear()
        for p in _RUNS.findall(whole) if self._by_runs else [whole]:
            pieces = known.get(p)
            if pieces is None:
                pieces = self._part(p)
                if len(p) <= _LONGEST_KEPT:
                    known[p] = pieces
            found.append(pieces)
        ids, sizes = np.frombuffer(b"".join(found), "<i4").reshape(-1, 2).T
        ends = np.cumsum(sizes, dtype=np.int64)
        return ids, places[ends - sizes], places[ends]

    def decode(self, ids: np.ndarray) -> str:
        """The text that ids stand for; broken byte sequences become U+FFFD."""
        surface = self._surface
        raw = b"".join([surface[i] for i in ids.tolist()])
        strip = len(ids) and not self._is_byte[ids[0]]
        if strip and (self.normalize.prefix or self.normalize.squeeze) and raw.startswith(b" "):
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


@cache
def encoder(path: str) -> PieceEncoder:
    """One encoder for each worker and file."""
    return PieceEncoder(path)


def _encode(path: str):
    def encode(batches):
        model = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                found = [model.encode(t.as_py()) for t in part.column(1)]
                lists = []
                for k, kind in enumerate((pa.int32(), pa.int64(), pa.int64())):
                    values = np.concatenate([f[k] for f in found]) if found else []
                    ends = np.cumsum([0, *[len(f[k]) for f in found]], dtype=np.int32)
                    lists.append(pa.ListArray.from_arrays(ends, pa.array(values, kind)))
                decoded = [model.decode(f[0]) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *lists, pa.array(decoded, pa.string())],
                    ["doc_id", "ids", "begins", "ends", "decoded"],
                )

    return encode


def encode_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Ids, byte spans and decoded text of every whole text.

    A NULL or empty text has no ids and decodes to the empty text. Rows are
    encoded one by one, repeated ones and those with a NULL id too; columns besides
    the two named are ignored.
    Returns ``doc_id, ids, begins, ends, decoded``.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    kind = "doc_id long, ids array<int>, begins array<long>, ends array<long>, decoded string"
    return texts.mapInArrow(_encode(path), kind)
