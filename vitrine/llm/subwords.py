"""Subword ids of whole texts, piece by piece through a bounded memory.

The byte-level pre-tokenizer starts a new word at any single space that stands between two characters
that are not white space, and merges never cross words.  So a text cut there encodes to the
same ids as the whole, and a piece that was seen before need not be encoded again.  A new piece of Latin letters, with or
without ASCII signs behind them, is two words to the pre-tokenizer, its letters and its signs (and twice that where a line feed stands between), and each word goes to the library's
model alone.  Other new pieces are encoded many at a time, as one text, and told apart by the lengths of their tokens in bytes.

The strings of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import re
from array import array
from codecs import charmap_decode
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A space between two characters that no definition of white space includes.
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Letters, then signs (but no apostrophe, which may begin a word of its own); perhaps the same again behind a line feed.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)(?:(\n[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*))?")
#: Pieces, and ends of pieces, a worker remembers (some 200 bytes each); pieces of more characters are not kept.
REMEMBERED, REMEMBERED_TAILS, LONGEST = 300_000, 50_000, 48
#: Pieces encoded as one text.
TOGETHER = 2000


class PieceEncoder:
    """Ids of texts; ``encode`` gives the ids of one text, ``lengths`` the bytes that each id stands for.

    ``word`` gives the ids of one word of the pre-tokenizer (as unsigned 32-bit integers), where the library lets its model be asked alone.
    """

    def __init__(self, encode: Callable[[str], list[int]], lengths: np.ndarray, word: Callable[[str], bytes] | None = None):
        self.encode, self.lengths, self.word = encode, lengths, word
        self.known: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    def texts(self, texts: Iterable[str], end: int, group_chars: int = 1 << 18) -> Iterator[np.ndarray]:
        """Ids of each text, in order, closed by ``end``; about ``group_chars`` of text are looked up at a time."""
        group: list[str] = []
        size = 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= group_chars:
                yield from self._group(group, end)
                group, size = [], 0
        yield from self._group(group, end)

    def _group(self, group: list[str], end: int) -> Iterator[np.ndarray]:
        cut = [text.split(" ") for text in group]
        firsts = [pieces.pop(0) for pieces in cut]
        seen: set[str] = set()
        for pieces in cut:
            seen.update(pieces)
        fresh: dict[str, bytes] = {}
        rest = self._plain(seen.difference(self.known), fresh)
        odd = {p for p in rest if not p or p[0].isspace() or p[-1].isspace()}
        rest.difference_update(odd)
        for i, pieces in enumerate(cut):
            if not firsts[i] or firsts[i][-1].isspace() or (odd and not odd.isdisjoint(pieces)):
                firsts[i], *cut[i] = CUT.split(group[i])
                rest.update(self._plain(set(cut[i]).difference(self.known, fresh), fresh))
        fresh.update(self._encoded(sorted(rest)))
        ids_of = self.known.__getitem__ if not fresh else lambda p: fresh[p] if p in fresh else self.known[p]
        self._remember(fresh)
        last = np.uint32(end).tobytes()
        for first, pieces in zip(firsts, cut):
            start = array("I", self.encode(first)).tobytes()
            yield np.frombuffer(b"".join((start, *map(ids_of, pieces), last)), dtype=np.uint32)

    def strings(self, texts: pa.Array, end: int) -> Iterator[np.ndarray]:
        """Ids of each text of a string array, closed by ``end``, in order.

        Texts are cut and their pieces told apart in Arrow; Python sees a piece once an array, and ids are gathered by places.
        """
        texts = texts.fill_null("")
        cut = pc.split_pattern(texts, " ")
        bounds = cut.offsets.to_numpy().astype(np.int64)
        coded = cut.values[bounds[0] : bounds[-1]].dictionary_encode()
        bounds -= bounds[0]
        pieces, at = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.int64)
        held = list(map(self.known.get, pieces))
        new = [i for i, ids in enumerate(held) if ids is None]
        fresh: dict[str, bytes] = {}
        rest = self._plain([pieces[i] for i in new], fresh)
        odd = {p for p in rest if not p or p[0].isspace() or p[-1].isspace()}
        fresh.update(self._encoded(sorted(rest.difference(odd))))
        for i in new:
            held[i] = fresh.get(pieces[i], b"")
        self._remember(fresh)  # before any text is given: who zips the ids to rows never comes back after the last
        # Texts with an odd piece, or white space at the end of the first, are cut anew by themselves.
        strange = np.array([p in odd for p in pieces] if odd else [False] * len(pieces), dtype=bool)
        first = [pieces[i] for i in at[bounds[:-1]].tolist()]
        alone = np.logical_or.reduceat(strange[at], bounds[:-1]) | np.array([not f or f[-1].isspace() for f in first]) if len(first) else np.zeros(0, dtype=bool)
        # Segments: the first piece without its space, the other pieces, the end.
        held.extend(b"" if a else array("I", self.encode(f)).tobytes() for f, a in zip(first, alone.tolist()))
        held.append(np.uint32(end).tobytes())
        flat = np.frombuffer(b"".join(held), dtype=np.uint32)
        size = np.fromiter(map(len, held), dtype=np.int64, count=len(held)) // 4
        start = np.cumsum(size) - size
        at[bounds[:-1]] = len(pieces) + np.arange(len(first))
        at = np.insert(at, bounds[1:], len(held) - 1)
        many = size[at]
        stop = np.cumsum(many)
        ids = flat[np.repeat(start[at] - (stop - many), many) + np.arange(int(stop[-1]) if len(stop) else 0)]
        ends = stop[bounds[1:] + np.arange(len(first))].tolist()
        before = 0
        for i, (after, by_itself) in enumerate(zip(ends, alone.tolist())):
            yield next(self._group([texts[i].as_py()], end)) if by_itself else ids[before:after]
            before = after

    def _remember(self, fresh: dict[str, bytes]) -> None:
        """Keep new pieces while there is room: those met first are the frequent ones."""
        room = REMEMBERED - len(self.known)
        if room > 0:
            self.known.update(islice(((p, ids) for p, ids in fresh.items() if len(p) <= LONGEST), room))

    def _plain(self, new: Iterable[str], fresh: dict[str, bytes]) -> set[str]:
        """Look up the plain ones of the ``new`` pieces, into ``fresh``; the others."""
        if self.word is None:
            return set(new)
        known, tails, word, rest = self.known, self.tails, self.word, set()
        for piece in new:
            if len(piece) > LONGEST:
                rest.add(piece)
                continue
            if piece.isalpha() and piece.isascii():
                if piece not in fresh:
                    fresh[piece] = word(" " + piece)
                continue
            match = PLAIN.fullmatch(piece)
            if match is None:
                rest.add(piece)
                continue
            letters, signs, line, more = match.groups()
            ids = known.get(letters) or fresh.get(letters)
            if ids is None:
                ids = fresh[letters] = word(" " + letters)
            if signs:
                ids += tails.get(signs) or self._tail(signs)
            if line:
                ids += (tails.get(line) or self._tail(line))
                if more:
                    ids += tails.get(more) or self._tail(more)
            fresh[piece] = ids
        return rest

    def _tail(self, word: str) -> bytes:
        """Ids of a word with no space before it; after a line feed they are two."""
        ids = self.word(word) if word[0] != "\n" else self.word("\n") + self.word(word[1:])
        if len(self.tails) < REMEMBERED_TAILS:
            self.tails[word] = ids
        return ids

    def _encoded(self, pieces: list[str]) -> Iterator[tuple[str, bytes]]:
        for at in range(0, len(pieces), TOGETHER):
            part = pieces[at : at + TOGETHER]
            ids = np.array(self.encode(" " + " ".join(part)), dtype=np.uint32)
            stops = np.cumsum([len(p.encode()) + 1 for p in part])
            after = np.searchsorted(np.cumsum(self.lengths[ids]), stops) + 1
            yield from zip(part, (x.tobytes() for x in np.split(ids, after[:-1])))


_ENCODERS: dict[tuple, PieceEncoder] = {}
#: The character that stands for each byte: itself where it prints, else the next one from 256 on.
_PRINTS = {*range(33, 127), *range(161, 173), *range(174, 256)}
_OTHERS = [b for b in range(256) if b not in _PRINTS]
_SHOWN = "".join(chr(b if b in _PRINTS else 256 + _OTHERS.index(b)) for b in range(256))


def json_encoder(name: str) -> PieceEncoder:
    """The encoder of a ``tokenizers`` file, one for each worker process."""
    if ("json", name) not in _ENCODERS:
        import public_tokenizers
        from tokenizers import Tokenizer

        reader = Tokenizer.from_file(public_tokenizers.path(name))
        reader.encode_special_tokens = True  # their strings in a text are ordinary text
        lengths = np.zeros(reader.get_vocab_size(), dtype=np.int64)
        for token, i in reader.get_vocab().items():
            lengths[i] = len(token)  # a character for each byte
        model = reader.model

        def word(text: str) -> bytes:
            return array("I", [t.id for t in model.tokenize(charmap_decode(text.encode(), "strict", _SHOWN)[0])]).tobytes()

        _ENCODERS["json", name] = PieceEncoder(
            lambda text: reader.encode_batch_fast([text], add_special_tokens=False)[0].ids, lengths,
            word)
    return _ENCODERS["json", name]


def rank_encoder(name: str) -> PieceEncoder:
    """The encoder of a ``tiktoken`` rank file, one for each worker process."""
    if ("rank", name) not in _ENCODERS:
        import base64

        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(name), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, i in ranks.items():
            lengths[i] = len(token)
        coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        _ENCODERS["rank", name] = PieceEncoder(coder.encode_ordinary, lengths)
    return _ENCODERS["rank", name]
