"""Encode texts through one of the public tokenizers, piece by piece with a cache.

A piece is a stretch of text that the tokenizer encodes on its own with the same result as in
place. Words repeat, so each worker keeps the pieces it has seen; the library encodes the
rest. A text for which the cut is not proven is given to the library whole.
"""

import os
import re
import struct
from itertools import chain

import numpy as np

from loomstead.llm.common import IS_SPACE

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
os.environ.setdefault("RAYON_NUM_THREADS", "1")

#: Bytes a task's pieces may take, by estimate, in two generations: a full one becomes the older,
#: of which those met again are taken over. Longer pieces are not kept, so that a piece, its ids
#: and their place in the dict take about ``EACH`` bytes.
CACHE_BYTES = 96 << 20
LONGEST, EACH = 48, 240
CACHED = CACHE_BYTES // EACH
#: Characters or bytes of texts whose pieces are looked up together.
TOGETHER = 1 << 20
#: Pieces are told apart by so many times eight bytes, on arrays.
PREFIX = 3
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_ODD_NUMBER = np.uint64(0x9E3779B97F4A7C15)
#: ASCII that is neither a letter nor white space.
_IS_OTHER = np.array([b < 0x80 and not chr(b).isalpha() and not IS_SPACE[b] for b in range(256)])
#: What ids of a piece are packed as.
_FORMATS = [f"<{n}I" for n in range(64)]

#: White space that the two regex engines may see differently, or beyond ASCII.
_ODD = [*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ODD_SPACE = re.compile("[" + "".join(map(chr, _ODD)) + "]")
#: Letters of Latin-1 up to an ASCII character that is none: no combining mark, no other
#: letter and no contraction can follow, so the match is one whole pre-token.
_LETTERS = r"[A-Za-zÀ-ÖØ-öø-ÿ]+(?=[\x00-\x40\x5b-\x60\x7b-\x7f]|\Z)"
PLAIN = re.compile(rf" ?{_LETTERS}\Z")
#: With the usual byte-level pattern a space goes with the word after it, and a run of white
#: space before a word gives up its last character.
SPACED = re.compile(rf" ?{_LETTERS}| ?[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+(?![^\x20\x09-\x0D])|[\x20\x09-\x0D]")
#: A tokenizer that drops white space sees nothing across it.
UNSPACED = re.compile(rf"{_LETTERS}|[^\x20\x09-\x0D]+")


def _byte_letters() -> dict[int, str]:
    """The letters byte-level vocabularies write bytes with: printable bytes of Latin-1 as
    they are, the others in order from code point 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in printable else next(rest)) for b in range(256)}


def spans(sizes: list[int], most: int):
    """Ranges of items in a row whose sizes add up to about ``most``."""
    first, held = 0, 0
    for k, size in enumerate(sizes, 1):
        held += size
        if held >= most or k == len(sizes):
            yield first, k
            first, held = k, 0


def word_pieces(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of ``UNSPACED`` start and end in UTF-8 that ends in white space: words,
    cut after leading letters of Latin-1 if an ASCII character follows."""
    space = IS_SPACE[data]
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    ends = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    other = np.flatnonzero(_IS_OTHER[data])
    at = np.append(other, len(data))[np.searchsorted(other, starts)]
    # No letter: a lead byte but that of U+00C0 to U+00FF, the signs of multiplication and division.
    bad = data > 0xC3
    bad |= data == 0xC2
    bad[:-1] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    bad = np.flatnonzero(bad)
    cut = (starts < at) & (at < ends)
    cut &= np.searchsorted(bad, starts) == np.searchsorted(bad, at)
    return np.sort(np.concatenate([starts, at[cut]])), np.sort(np.concatenate([ends, at[cut]]))


def told_apart(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of one of each kind of equal pieces, and for each piece the place of its kind's
    among these. Pieces of more than 8 * ``PREFIX`` bytes are kinds of their own; ``raw`` ends
    with as many bytes to spare."""
    size = ends - starts
    whole = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
    parts = [whole[starts + 8 * k] & _MASKS[np.clip(size - 8 * k, 0, 8)] for k in range(PREFIX)]
    key = size.astype(np.uint64)
    for part in parts:
        key = (key ^ (key >> np.uint64(29))) * _ODD_NUMBER + part
    long = size > 8 * PREFIX
    key *= _ODD_NUMBER
    _, first, which = np.unique(key, return_index=True, return_inverse=True)
    # Equal keys are only taken for equal pieces where all bytes are.
    same = size == size[first[which]]
    for part in parts:
        same &= part == part[first[which]]
    alone = np.flatnonzero(long | ~same)
    which[alone] = len(first) + np.arange(len(alone))
    return np.concatenate([first, alone]), which


class Pieces:
    """Encodes texts with the tokenizer file at ``path``; ``keep`` says what is remembered of
    the ids of a piece, ``share`` which part of ``CACHED`` a generation may take."""

    def __init__(self, path: str, keep, split: re.Pattern, lower: bool, odd: re.Pattern | None, share: int = 2):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.keep, self.split, self.lower, self.odd = keep, split.findall, lower, odd
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special_bytes = [x.encode() for x in self.specials]
        self.letters = _byte_letters()
        self.most = CACHED // share
        self.seen: dict = {}
        self.before: dict = {}

    def whole(self, text: str):
        return self.keep(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str):
        """One plain word is one pre-token, so the model can have it at once."""
        if self.lower and (low := word.lower()) != word:
            if (known := self.seen.get(low)) is not None:
                return known
            word = low
        if word.isascii():  # letters, whose bytes are written as they are, and perhaps a space
            written = word.replace(" ", self.letters[0x20])
        else:
            written = word.encode().decode("latin-1").translate(self.letters)
        return self.keep([t.id for t in self.model.tokenize(written)])

    def _cut(self, text: str) -> list | None:
        """The keys of a text's pieces, or None where it can't be cut."""
        if (self.odd and self.odd.search(text)) or any(s in text for s in self.specials):
            return None
        return self.split(text)

    def _learn(self, pieces: list) -> list:
        """What is kept of pieces, each named once, that are not in ``seen``; all but the long ones are now."""
        seen, before, word = self.seen, self.before.get, self._word
        out = list(map(before, pieces)) if self.before else [None] * len(pieces)
        other = []
        for k, (p, known) in enumerate(zip(pieces, out, strict=True)):
            if known is None:
                if not ((p.isascii() and p.isalpha()) or PLAIN.match(p)):
                    other.append(k)
                    continue
                out[k] = known = word(p)
            if len(p) <= LONGEST:
                seen[p] = known
        encoded = self.tokenizer.encode_batch([pieces[k] for k in other], add_special_tokens=False) if other else ()
        for k, e in zip(other, encoded, strict=True):
            out[k] = self.keep(e.ids)
            if len(pieces[k]) <= LONGEST:
                seen[pieces[k]] = out[k]
        return out

    def _kept(self, pieces: list, distinct: bool) -> list:
        """What is kept of each piece in turn."""
        if len(self.seen) > self.most:
            self.before, self.seen = self.seen, {}
        kept = list(map(self.seen.get, pieces))
        late = [k for k, x in enumerate(kept) if x is None]
        new = [pieces[k] for k in late]
        if distinct:
            learnt = self._learn(new)
        else:
            once = list(dict.fromkeys(new))
            learnt = map(dict(zip(once, self._learn(once), strict=True)).__getitem__, new)
        for k, x in zip(late, learnt, strict=True):
            kept[k] = x
        return kept

    def each(self, texts: list[str]):
        """For each text what is kept of each piece in turn; of the whole text where it can't be cut."""
        for a, z in spans([len(t) for t in texts], TOGETHER):
            cuts = [self._cut(t) for t in texts[a:z]]
            kept, at = self._kept(list(chain.from_iterable(filter(None, cuts))), False), 0
            for text, pieces in zip(texts[a:z], cuts, strict=True):
                if pieces is None:
                    yield [self.whole(text)]
                else:
                    yield kept[at : at + len(pieces)]
                    at += len(pieces)

    def ids(self, texts: list[bytes]):
        """The ids of each text (UTF-8), for tokenizers that drop white space and keep ids as
        bytes: pieces are found and told apart on arrays, and only distinct ones are looked up."""
        for a, z in spans([len(t) for t in texts], TOGETHER):
            some = texts[a:z]
            odd = {k for k, t in enumerate(some) if any(s in t for s in self.special_bytes)}
            raw = b"\n".join([b"" if k in odd else t for k, t in enumerate(some)]) + b"\n" + bytes(8 * PREFIX)
            upto = np.cumsum([1 if k in odd else len(t) + 1 for k, t in enumerate(some)])
            starts, ends = word_pieces(np.frombuffer(raw, np.uint8)[: upto[-1]])
            first, which = told_apart(raw, starts, ends)
            kept = self._kept([raw[i:j].decode() for i, j in zip(starts[first].tolist(), ends[first].tolist(), strict=True)], True)
            sizes = np.fromiter(map(len, kept), np.int64, len(kept)) // 4
            numbers, n = np.frombuffer(b"".join(kept), "<u4"), sizes[which]
            done = np.cumsum(n)
            at = np.arange(int(done[-1]) if len(n) else 0) + np.repeat((np.cumsum(sizes) - sizes)[which] - (done - n), n)
            out, edges = numbers[at], np.append(0, done)[np.searchsorted(starts, upto)].tolist()
            for k, (text, i, j) in enumerate(zip(some, [0, *edges], edges, strict=False)):
                yield self.whole(text.decode()) if k in odd else out[i:j].tobytes()

    def of(self, text: str) -> list:
        """``each`` of one text."""
        return next(self.each([text]))


def packed_ids(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    n = len(ids)
    return struct.pack(_FORMATS[n] if n < len(_FORMATS) else f"<{n}I", *ids)


def counter(path: str) -> Pieces:
    """Token counts by a byte-level BPE with the usual pattern."""
    return Pieces(path, len, SPACED, lower=False, odd=ODD_SPACE)


def id_bytes(path: str) -> Pieces:
    """Ids as little-endian unsigned 32-bit numbers, by a tokenizer that composes, lower-cases
    and drops white space. Distinct pieces of a megabyte are looked up once, so a third of the
    memory serves."""
    return Pieces(path, packed_ids, UNSPACED, lower=True, odd=None, share=6)
