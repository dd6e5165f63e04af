"""Token ids of a public word-BPE vocabulary, by pieces that recur.

No token of such a vocabulary spans white space or the end of a word, digit or run of
signs, so a text's ids are those of its pieces. Each worker keeps the ids of lower-case
pieces it has met, and encodes new ones many at a time. Only white-space separated
parts with letters or signs beyond Latin-1 go to the tokenizer as they are.
"""

from __future__ import annotations

import os
import re
from functools import cache

import numpy as np
from tokenizers import Tokenizer

#: Pieces whose ids a worker remembers within a task.
_PIECES_KEPT = 300_000
#: Longer pieces are seldom words; their ids are not kept.
_LONGEST_KEPT = 64
_PIECES_AT_ONCE = 512
#: How the vocabulary splits lower-case text, what begins a special token,
#: and what ends the last token of a piece.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+", re.ASCII)
_SPECIAL = "<|"
_END = "</w>"
#: Letters beyond ASCII whose lower case and normal form depend on nothing around them.
_FOREIGN = re.compile(r"[^\x00-\x7fÀ-ÖØ-öø-ÿ]")
_PARTS = re.compile(r"\S+", re.ASCII)


def _plain(text: str) -> bool:
    return (text.isascii() or not _FOREIGN.search(text)) and _SPECIAL not in text


class WordTokenizer:
    """Encodes texts with the tokenizer of ``path``, without special tokens."""

    def __init__(self, path: str):
        # Spark runs a worker for each core; more threads would only wait for them.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self._tokenizer = Tokenizer.from_file(path)
        names = map(self._tokenizer.id_to_token, range(self._tokenizer.get_vocab_size()))
        self._ends = np.array([n is not None and n.endswith(_END) for n in names])
        self._known: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        codes = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(c.ids, "<u4") for c in codes]

    def _encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of lower-case pieces, told apart by the tokens that end one."""
        step = _PIECES_AT_ONCE
        joined = [" ".join(pieces[at : at + step]) for at in range(0, len(pieces), step)]
        ids = np.concatenate(self._encode(joined)) if joined else np.empty(0, "<u4")
        ends = (4 * (np.flatnonzero(self._ends[ids]) + 1)).tolist()
        raw = ids.tobytes()
        cuts = zip([0, *ends], ends)
        return {p: raw[start:end] for p, (start, end) in zip(pieces, cuts, strict=True)}

    def _split(self, text: str, foreign: set[str]) -> list[str]:
        """The text's pieces; parts that go to the tokenizer whole are added to ``foreign``."""
        if _plain(text):
            return _PIECES.findall(text.lower())
        out = []
        for part in _PARTS.findall(text):
            if _plain(part):
                out += _PIECES.findall(part.lower())
            else:
                foreign.add(part)
                out.append(part)
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit numbers; NULL has none."""
        foreign: set[str] = set()
        pieces = [self._split(t or "", foreign) for t in texts]
        known = self._known
        if len(known) > _PIECES_KEPT:
            known.clear()
        new = set().union(*pieces).difference(known)
        known.update(self._encode_pieces(sorted(new - foreign)))
        whole = sorted(new & foreign)
        known.update(zip(whole, (ids.tobytes() for ids in self._encode(whole)), strict=True))
        get = known.__getitem__
        out = [b"".join(map(get, p)) for p in pieces]
        for p in new:
            if len(p) > _LONGEST_KEPT:
                del known[p]
        return out

    def forget(self) -> None:
        """Lets go of all ids kept; they are encoded again where they are needed."""
        self._known.clear()


@cache
def tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for each worker and file."""
    return WordTokenizer(path)
