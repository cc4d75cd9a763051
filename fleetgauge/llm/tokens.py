"""Whole-text encoding with public tokenizer files, each distinct piece of text encoded once per worker.

A text is cut only at places where the tokenizer itself always cuts and where neither side can see across, so the ids of
the pieces in a row are the ids of the text.  Texts with white space that does not fit the rule are encoded whole.
"""

from __future__ import annotations

import os
import re
import string
from array import array

import numpy as np

from fleetgauge.llm.common import FORGET, claim_worker

# White space other than space and line feed, in Python's wider sense of it; fixed values.
_BLANKS = [chr(c) for c in (9, 11, 12, 13, 28, 29, 30, 31, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
                            0x202F, 0x205F, 0x3000)]


# How the word tokenizer itself splits printable ASCII, lower-cased; fixed values.
_WORD_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ a-z0-9]+")
# ASCII signs it cuts from a letter beside them, whatever the letter; "'" may belong to what follows.
_SIGNS = string.punctuation.replace("'", "")
_LOT = 512  # pieces to a call


class _Known(dict):
    """Pieces and their ids in two generations: when the younger one is full, the older one is forgotten, and what is still
    used has moved on by then."""

    def __init__(self, most: int):
        self.most, self.held, self.old = most, 0, {}

    def settle(self) -> None:
        if self.held > self.most // 2:
            self.old, self.held = dict(self), 0
            self.clear()

    def unknown(self, pieces: set[str]) -> list[str]:
        fresh = pieces.difference(self)
        kept = [x for x in fresh if x in self.old]
        self.learn(kept, [self.old[x] for x in kept])
        return list(fresh.difference(kept))

    def learn(self, pieces: list[str], ids: list[bytes]) -> None:
        self.update(zip(pieces, ids, strict=True))
        self.held += 150 * len(pieces) + sum(map(len, pieces)) + sum(map(len, ids))


class ChunkEncoder:
    """``encode(texts)`` gives per text its ids as little-endian unsigned 32-bit integers.

    ``byte_level``: pieces start at a space that follows a non-blank, the space belonging to the piece after it, as in
    byte-level BPE.  Otherwise blanks carry no ids (the normalizer makes them one space, the splitter drops it) and
    pieces are what stands between spaces, cut again where the tokenizer's own rule cuts.  Pieces that are new are encoded
    many to a call, as one text with spaces between, and told apart by the tokens that begin with a space (byte-level) or
    end a word.  The memory holds about ``most`` bytes and forgets what has not been used for long.
    """

    def __init__(self, path: str, byte_level: bool, most: int = 80_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task uses one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.byte_level, self.known = byte_level, _Known(most)
        # Tokens that begin a piece (byte-level) or end one.
        vocabulary = self.tokenizer.get_vocab()
        self.edge = np.zeros(max(vocabulary.values()) + 1, bool)
        self.edge[[i for token, i in vocabulary.items() if (token.startswith("Ġ") if byte_level else token.endswith("</w>"))]] = True

    def _raw(self, pieces: list[str]) -> list[bytes]:
        encode = self.tokenizer.encode_batch_fast
        # In small lots: an encoding holds far more than its ids.
        return [array("I", x.ids).tobytes() for at in range(0, len(pieces), 4096)
                for x in encode(pieces[at:at + 4096], add_special_tokens=False)]

    def _together(self, pieces: list[str]) -> list[bytes]:
        """As ``_raw`` of printable pieces, in byte-level mode after a space, otherwise of one word each."""
        before, out = " " if self.byte_level else "", []
        for at in range(0, len(pieces), _LOT):
            lot = pieces[at:at + _LOT]
            [found] = self.tokenizer.encode_batch_fast([before + " ".join(lot)], add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            edges = np.flatnonzero(self.edge[ids])
            if len(edges) != len(lot):  # a piece the tokenizer takes for several words, or for none
                out += self._raw([before + x for x in lot])
                continue
            starts, ends = (edges, np.append(edges[1:], len(ids))) if self.byte_level else (np.append(0, edges[:-1] + 1), edges + 1)
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip((starts * 4).tolist(), (ends * 4).tolist(), strict=True)]
        return out

    def _cut(self, piece: str) -> list[str]:
        """The parts the word tokenizer's rule makes of a piece, as far as it is plain."""
        if not piece.isprintable():
            return []
        if piece.isascii():
            return _WORD_SPLIT.findall(piece.lower())
        core = piece.strip(_SIGNS)
        low = core.lower()
        if not core or not (core[0].isalpha() and core[-1].isalpha() and low[0].isalpha() and low[-1].isalpha()):
            return []
        start = piece.index(core)
        return [x for x in (piece[:start], core, piece[start + len(core):]) if x]

    def _pieces(self, text: str) -> list[str] | None:
        """Pieces; in byte-level mode all but the first stand for themselves with a space before."""
        if not self.byte_level:
            return text.replace("\n", " ").split(" ")
        if "  " in text or "\n " in text or any(c in text for c in _BLANKS):
            return None
        return text.split(" ")

    def _learn(self, pieces: set[str]) -> None:
        """Make all pieces known."""
        fresh, parts = self.known.unknown(pieces), {}
        if not self.byte_level:
            parts = {x: cut for x in fresh if len(cut := self._cut(x)) > 1}
            fresh = self.known.unknown({x for x in fresh if x not in parts}.union(*parts.values()))
        if self.byte_level:
            plain = [x for x in fresh if x.isprintable() and x]
        else:
            plain = [x for x in fresh if x.isalpha() and x.lower().isalpha()]
        self.known.learn(plain, self._together(plain))
        others = list(set(fresh).difference(plain))
        self.known.learn(others, self._raw([(" " if self.byte_level else "") + x for x in others]))
        self.known.learn(list(parts), [b"".join([self.known[x] for x in cut]) for cut in parts.values()])

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self._pieces(text) for text in texts]
        self.known.settle()
        distinct: set[str] = set()
        for pieces in cut:
            if pieces:
                distinct.update(pieces[1:] if self.byte_level else pieces)
        self._learn(distinct)
        known, out = self.known.__getitem__, []
        heads = self._raw([text if pieces is None else pieces[0] for text, pieces in zip(texts, cut, strict=True)]) \
            if self.byte_level else None
        for i, pieces in enumerate(cut):
            if pieces is None:
                out.append(heads[i])
            elif self.byte_level:
                out.append(heads[i] + b"".join(map(known, pieces[1:])))
            else:
                out.append(b"".join(map(known, pieces)))
        return out


_ENCODERS: dict[tuple[str, bool], ChunkEncoder] = {}
FORGET["tokens"] = _ENCODERS.clear


def encoder(path: str, byte_level: bool) -> ChunkEncoder:
    """One per worker process and file, kept between tasks of the modules that encode."""
    claim_worker("tokens")
    key = (path, byte_level)
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(path, byte_level)
    return _ENCODERS[key]
