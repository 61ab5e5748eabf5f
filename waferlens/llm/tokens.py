"""Token ids of whole texts by a public byte-level BPE vocabulary.

The vocabulary's pre-tokeniser cuts a text into pieces and byte-pair merges
never cross them.  So the ids of a text are the ids of its pieces, one after
another, and a piece seen before need not be merged again.  ``PieceEncoder``
keeps a bounded table of pieces; every entry comes from the tokenizers library
itself.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Sequence
from functools import lru_cache

import numpy as np
import regex

# Fixed value: the pre-tokeniser pattern of this public vocabulary.
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# The same over ASCII and Latin letters alone, for the faster standard module.
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
_LATIN_TEXT = re.compile(rf"[\x00-\x7f{_LATIN}]*")
_LATIN_PIECE = re.compile(rf" ?[{_LATIN}]+| ?[0-9]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\t-\r {_LATIN}0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")


def default_vocabulary() -> str:
    """Path of the public 50k byte-level BPE file on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Table(dict):
    """Ids by piece.  A piece of the generation before moves here; one that neither has is noted and gives None."""

    def __init__(self, before: dict[str, bytes]) -> None:
        super().__init__()
        self.before = before
        self.absent: list[str] = []

    def __missing__(self, key: str) -> bytes | None:
        ids = self.before.get(key)
        if ids is None:
            self.absent.append(key)
        else:
            self[key] = ids
        return ids


class PieceEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids, as bytes.

    ``None`` and empty texts give no ids; a special token written out in a
    text is that token, as the library has it.  ``max_pieces`` bounds a generation
    of the table; a full one is kept until the next is full, so at most twice
    as many pieces are held.
    """

    def __init__(self, vocabulary: str | None = None, max_pieces: int = 500_000) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(vocabulary or default_vocabulary())
        # The library takes these out of a text before its pre-tokeniser sees the rest, so they cut it here, too.
        added = sorted((t.content for t in self._tokenizer.get_added_tokens_decoder().values()), key=lambda c: -len(c))
        if any(t.lstrip or t.rstrip or t.single_word for t in self._tokenizer.get_added_tokens_decoder().values()):
            raise ValueError("added tokens that take in spaces or stand as whole words only are not supported")
        self._added = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        self.size = size = self._tokenizer.get_vocab_size()
        self._leads = np.array([(self._tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(size)])
        self._max = max_pieces
        self._table = _Table({})

    def _ids(self, texts: Sequence[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _learn(self, pieces: Iterable[str]) -> None:
        """Pieces that a space leads are encoded 1,000 to a text, which is cut where a space leads an id; the others one by one."""
        led, bare = [], []
        for p in pieces:
            (led if p[0] == " " and not p[-1].isspace() else bare).append(p)
        self._table.update(zip(bare, self._ids(bare), strict=True))
        for i in range(0, len(led), 1000):
            part = led[i : i + 1000]
            ids = np.frombuffer(self._ids(["".join(part)])[0], dtype="<u4")
            starts = np.flatnonzero(self._leads[ids])
            if len(starts) != len(part):
                self._table.update(zip(part, self._ids(part), strict=True))
                continue
            raw, cuts = ids.tobytes(), [*(starts * 4).tolist(), len(ids) * 4]
            self._table.update(zip(part, [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], strict=True))

    def _pieces(self, text: str) -> list[str]:
        pattern = _LATIN_PIECE if _LATIN_TEXT.fullmatch(text) else _PIECE
        if self._added is None or not self._added.search(text):
            return pattern.findall(text)
        # Every second part is an added token, which is a piece of its own.
        return [p for k, part in enumerate(self._added.split(text)) for p in ([part] if k % 2 else pattern.findall(part))]

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        if len(self._table) > self._max:
            self._table = _Table(dict(self._table))
        table = self._table
        pieces = [self._pieces(t) if t else [] for t in texts]
        found = [list(map(table.__getitem__, ps)) for ps in pieces]
        if table.absent:
            absent, table.absent = dict.fromkeys(table.absent), []
            self._learn(absent)
            found = [[table[p] if x is None else x for p, x in zip(ps, ids, strict=True)] if None in ids else ids for ps, ids in zip(pieces, found, strict=True)]
        return [b"".join(ids) for ids in found]


@lru_cache(maxsize=2)
def shared_encoder(vocabulary: str | None = None) -> PieceEncoder:
    """The encoder of this process: a worker that runs one task after another reads the vocabulary once and keeps its table."""
    return PieceEncoder(vocabulary)
