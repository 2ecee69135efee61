"""Whole texts to token ids with a ``tokenizers`` file, piece by piece.

Both vocabularies cut a text into pieces before any merge, and a cut always falls
before a space that a non-space follows; the lower-casing one also drops white space
altogether. So the ids of a text are the ids of its pieces, which the library encodes
once while they stay in a cache of two generations of ``CACHE`` pieces. The texts of
a group are cut and their distinct pieces numbered by Arrow, so a repeated piece costs
an array lookup. A plain word goes straight to the library's merge model, since its
normaliser and splitter would only lower its case. Results equal those of one library
call per text (see the tests); memory is bounded by the cache and one group of texts,
which is about ``GROUP_BYTES`` or one longer text.
"""

from __future__ import annotations

import os
import re
import string
import sys
from collections.abc import Iterator

CACHE = 500_000
GROUP_BYTES = 4 << 20

#: A single line end between words is a piece border on both sides; it travels as a mark at the front of the next word.
_LINE, _MARK = re.compile(r"(?<=\S)\n(?=\S)"), "\x00"
#: A space inside a piece.
_INNER = "\x01"
_SPACES = re.compile(r" (?=\s|\Z)")
_RARE_BLANKS = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace() and chr(c) not in " \n"]
#: Not a letter that both vocabularies keep as it is, or only lower.
_FOREIGN = re.compile("[^A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]")
#: Signs that end a word: ASCII punctuation but for the apostrophe and the underscore.
_TAIL = "".join(set(string.punctuation) - set("'_"))



class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        encode = lambda text: self.library.encode(text, add_special_tokens=False).ids
        # a vocabulary that keeps white space puts the space at the front of the next piece
        self.keeps_space = encode("a b") != encode("a") + encode("b")
        self.lowers = encode("AB") == encode("ab")
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        spelt = lambda c: "".join(s for s, _ in spell.pre_tokenize_str(c))
        self.spelling = {chr(c): spelt(chr(c)) for c in range(0x100)}
        self.lead = spelt(" ") if self.keeps_space else ""
        self.bytes_of = [i.to_bytes(4, "little") for i in range(self.library.get_vocab_size())]
        self.line = self._whole(["\n"])[0]
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def _pieces(self, text: str) -> tuple[str, str]:
        """The first part of ``text``, which stands for itself, and the others between single spaces."""
        if not self.keeps_space:
            return "", text.replace("\n", " ")
        if _MARK in text or _INNER in text:
            return text, ""
        plain = not any(c in text for c in _RARE_BLANKS)
        if "\n" in text:
            if plain and not ("\n\n" in text or " \n" in text or "\n " in text or text[0] == "\n" or text[-1] == "\n"):
                text = text.replace("\n", " " + _MARK)
            else:
                plain, text = False, _LINE.sub(" " + _MARK, text)
        if not (plain and "  " not in text and text[-1:] != " "):
            # white space after a space belongs to the piece before
            text = _SPACES.sub(_INNER, text)
        first, _, others = text.partition(" ")
        return first.replace(_INNER, " "), others

    def forget(self) -> None:
        """Empty the cache."""
        self.known, self.older = {"": b""}, {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, without special tokens."""
        import pyarrow as pa

        return list(self.column(pa.array(texts, pa.large_string())))

    def column(self, column) -> Iterator[bytes]:
        """Ids of each text of an Arrow column, without special tokens; a null text is empty."""
        import numpy as np
        import pyarrow.compute as pc

        size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        a = 0
        while a < len(column):
            before = int(size[a - 1]) if a else 0
            b = max(a + 1, int(np.searchsorted(size, before + GROUP_BYTES, side="right")))
            yield from self._group([t or "" for t in column.slice(a, b - a).to_pylist()])
            a = b

    def _whole(self, pieces: list[str]) -> list[bytes]:
        from array import array

        return [array("I", x.ids).tobytes() for x in self.library.encode_batch_fast(pieces, add_special_tokens=False)]

    def _learn(self, new) -> None:
        """Put the ids of new pieces into the cache."""
        known, older, hard = self.known, self.older, []
        merge, spell, line, spelling, foreign = self.library.model.tokenize, self.bytes_of, self.line, self.spelling, _FOREIGN.search
        for piece in new:
            ids = older.get(piece)
            if ids is not None:
                known[piece] = ids
                continue
            lead, front, body = self.lead, b"", piece
            if line and body[0] == _MARK:
                lead, front, body = "", line, body[1:]
            core = body.rstrip(_TAIL)
            ascii = core.isascii()
            if not core.isalpha() or not ascii and foreign(core):
                hard.append(piece)
                continue
            tail = body[len(core):]
            if self.lowers:
                core = core.lower()
            name = _MARK + core if front else core
            ids = None if name == piece else known.get(name) or older.get(name)
            if ids is None:
                spelt = core if ascii else "".join([spelling[c] for c in core])
                ids = front + b"".join([spell[t.id] for t in merge(lead + spelt)])
                known[name] = ids
            if tail:
                # kept apart by a tab, which no piece of this kind holds
                end = known.get("\t" + tail)
                if end is None:
                    end = known["\t" + tail] = self._whole([tail])[0]
                known[piece] = ids + end
            else:
                known[piece] = ids
        lead = " " if self.keeps_space else ""
        if hard:
            spoken = ["\n" + p[1:] if self.line and p[0] == _MARK else lead + p for p in hard]
            if self.keeps_space:
                spoken = [p.replace(_INNER, " ") for p in spoken]
            known.update(zip(hard, self._whole(spoken)))

    def _group(self, texts):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        firsts, others = zip(*map(self._pieces, texts))
        heads = self._whole(list(firsts)) if self.keeps_space else [b""] * len(texts)
        lists = pc.split_pattern(pa.array(others, pa.large_string()), " ")
        coded = lists.flatten().dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [p for p in pieces if p not in self.known]
        if new:
            if len(self.known) + len(new) > CACHE:
                self.known, self.older = {"": b""}, self.known
                new = [p for p in pieces if p]
            self._learn(new)
        bodies = [self.known[p] for p in pieces]
        # the ids of every piece in turn, taken from the ids of the distinct pieces
        length = np.fromiter(map(len, bodies), np.int64, len(bodies)) // 4
        which = coded.indices.to_numpy()
        counts = length[which]
        ends = np.concatenate([[0], np.cumsum(counts)])
        at = np.repeat((np.cumsum(length) - length)[which] - ends[:-1], counts) + np.arange(ends[-1])
        ids = np.frombuffer(b"".join(bodies), dtype="<u4")[at].tobytes()
        cut = (4 * ends[lists.offsets.to_numpy()]).tolist()
        return [h + ids[a:b] for h, a, b in zip(heads, cut, cut[1:])]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
