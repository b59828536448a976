"""Token ids of whole texts as the tokenizers library gives them, with repeated pieces encoded once a worker.

Both vocabularies cut a text into runs of letters and runs of other characters before they merge. So a text can be cut
before white space, after a run of letters, and before one unless an apostrophe stands there (contractions). Words that hold
anything but Latin letters and printable ASCII are cut at white space only. A text with other white space or control
characters, or with the start of a special token, is encoded whole.

Pieces between cuts are looked up, many at once, by a 64-bit hash of their bytes in a table; the library encodes those that are
new. The table is emptied between chunks of texts when it holds many pieces, and grows where one chunk (a very long text) brings more. Longer pieces than ``KEPT_LENGTH`` are always encoded.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

TABLE_BITS = 21  # of an empty table
KEPT_PIECES = 700_000
KEPT_LENGTH = 48  # bytes
CHUNK_BYTES = 1 << 19  # texts looked up together
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-įı-ſ"
_PLAIN = re.compile(f"[\t\n\r -~{_LETTER}]*")
_UNUSUAL = re.compile(f"[^\t\n\r -~{_LETTER}]")
_UNCUT = re.compile("<\\||[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]")
_LATIN = bytes(b for b in range(256) if _PLAIN.fullmatch(chr(b)))
_SPACE, _WORD, _OTHER = 0, 1, 2
_CLASS = np.array([_SPACE if b in b" \t\n\r" else _WORD if chr(b).isalpha() or b >= 128 else _OTHER for b in range(256)], np.uint8)
_BASE = 0x9E3779B97F4A7C15
_RUN = re.compile(f" ?[{_LETTER}]+")  # one word of the pre-tokenizers, with a blank before it or none


def _byte_characters() -> dict[int, str]:
    """Printable Latin-1 characters stand for their own byte, all other bytes for the characters from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in own)}


_BYTE_CHARACTERS = _byte_characters()


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def plain(text: str) -> bool:
    """Whether a text holds nothing but Latin letters, printable ASCII and usual white space."""
    try:
        return not text.encode("latin-1").translate(None, _LATIN)
    except UnicodeEncodeError:
        return _PLAIN.fullmatch(text) is not None


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _hashes(chars: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _powers(1 << max(10, len(chars).bit_length()))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * up[: len(chars)])])
    h = (total[ends] - total[starts]) * down[starts]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return (h ^ (h >> np.uint64(33))) | np.uint64(1)  # 0 marks a free place


class _Table:
    """Ids by hash, with linear probing; many keys at a time. At most half of the places are taken."""

    def __init__(self):
        self._clear(TABLE_BITS)
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.count = 0

    def _clear(self, bits: int) -> None:
        self.bits, self.keys, self.entry = bits, np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def _put(self, keys: np.ndarray, entries: np.ndarray) -> None:
        todo, place = np.arange(len(keys)), self._place(keys)
        while len(todo):
            free = self.keys[place] == 0
            self.keys[place[free]] = keys[todo[free]]  # of several that take one place the last one has it
            won = self.keys[place] == keys[todo]
            self.entry[place[won]] = entries[todo[won]]
            todo, place = todo[~won], (place[~won] + 1) & ((1 << self.bits) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Entry of each key, -1 where it is not held."""
        found, todo, place = np.full(len(keys), -1, np.int64), np.arange(len(keys)), self._place(keys)
        while len(todo):
            there = self.keys[place]
            hit = there == keys[todo]
            found[todo[hit]] = self.entry[place[hit]]
            go = ~hit & (there != 0)
            todo, place = todo[go], (place[go] + 1) & ((1 << self.bits) - 1)
        return found

    def add(self, keys: np.ndarray, ids: list[bytes]) -> None:
        """Hold new, distinct keys."""
        sizes = np.array([len(x) // 4 for x in ids], np.int64)
        self.first = np.concatenate([self.first, len(self.ids) + sizes.cumsum() - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), "<u4")])
        entries = self.count + np.arange(len(keys))
        self.count += len(keys)
        if 2 * self.count > len(self.keys):
            taken = self.keys != 0
            held = self.keys[taken], self.entry[taken]
            self._clear(self.count.bit_length() + 1)
            self._put(*held)
        self._put(keys, entries)


class WordTokenizer:
    def __init__(self, path: str, separator: str = "<|endoftext|>"):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library, self.separator = Tokenizer.from_file(path), separator
        self.between = self.library.token_to_id(separator)
        self.table = _Table()
        self.model = self.library.model
        self.lowers, self.blank = self._word_rules()

    def _word_rules(self) -> tuple[bool, str | None]:
        """Whether words are put in lower case, and what a blank before a word becomes; None where words are not taken whole.

        Normaliser and pre-tokenizer leave a run of letters as one word of byte characters. That is asked of the library
        once, so that runs can go to its model directly.
        """

        def words(text: str) -> list[str]:
            normal = self.library.normalizer.normalize_str(text) if self.library.normalizer else text
            return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

        if self.library.pre_tokenizer is None or len(words("Abé")) != 1 or len(words(" Abé")) != 1:
            return False, None
        lowers = words("Abé") == [self._bytes_as_characters("abé")]
        for text, blank in ((" Abé", ""), (" Abé", "\u0120")):
            if words("Abé") == [self._bytes_as_characters("abé" if lowers else "Abé")] and words(text) == [blank + words("Abé")[0]]:
                return lowers, blank
        return lowers, None

    @staticmethod
    def _bytes_as_characters(text: str) -> str:
        """The character that byte-level vocabularies write for each byte."""
        return text.encode().decode("latin-1").translate(_BYTE_CHARACTERS)

    def whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _encode(self, pieces: list[str]) -> list[bytes]:
        """Each piece by the library: single words by its model, others by all of it."""
        if self.blank is None:
            return self._encode_others(pieces)
        others = [p for p in pieces if not _RUN.fullmatch(p)]
        rest, tokenize = iter(self._encode_others(others)), self.model.tokenize
        out = []
        for piece in pieces:
            if not _RUN.fullmatch(piece):
                out.append(next(rest))
                continue
            word = piece.lstrip(" ")
            word = self._bytes_as_characters(word.lower() if self.lowers else word)
            out.append(array("I", [t.id for t in tokenize(self.blank + word if piece[0] == " " else word)]).tobytes())
        return out

    def _encode_others(self, pieces: list[str]) -> list[bytes]:
        """A special token between two pieces keeps them apart, and its id marks the cut."""
        out: list[bytes] = []
        if not pieces:
            return out
        for at in range(0, len(pieces), 2000):
            ids = array("I", self.library.encode_batch_fast([self.separator.join(pieces[at:at + 2000])], add_special_tokens=False)[0].ids)
            raw, start = ids.tobytes(), 0
            for cut in [*np.flatnonzero(np.frombuffer(raw, "<u4") == self.between).tolist(), len(ids)]:
                out.append(raw[4 * start:4 * cut])
                start = cut + 1
        return out

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null is empty."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and size < CHUNK_BYTES:
                size += len(texts[end] or "")
                end += 1
            yield from self._chunk(texts[at:end])
            at = end

    def _cuts(self, raws: list[bytes], texts: list[str], usual: list[bool]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of all texts, where their pieces begin, and which piece is each text's first."""
        chars = np.frombuffer(b"".join(raws), np.uint8)
        opens = np.concatenate([[0], np.cumsum([len(r) for r in raws])]).astype(np.int64)
        kind = _CLASS[chars]
        before = np.concatenate([np.zeros(1, np.uint8), kind[:-1]])
        word = (kind == _SPACE) & (before != _SPACE)
        inner = (kind != _SPACE) & (before != _SPACE) & (kind != before)
        inner[1:] &= ~((kind[1:] == _WORD) & (chars[:-1] == ord("'")))
        word[opens[:-1]] = True
        if not all(usual):
            numbers = np.cumsum(word)
            for i, ok in enumerate(usual):
                if not ok:  # words with unusual characters stay whole
                    low, high = opens[i], opens[i + 1]
                    places = low + np.flatnonzero((chars[low:high] & 0xC0) != 0x80)
                    odd = np.unique(numbers[places[[m.start() for m in _UNUSUAL.finditer(texts[i])]]])
                    inner[low:high] &= ~np.isin(numbers[low:high], odd)
        starts = np.flatnonzero(word | inner)
        return chars, starts, np.searchsorted(starts, opens)

    def _chunk(self, texts: list[str | None]) -> Iterator[bytes]:
        cut = [i for i, t in enumerate(texts) if t and not _UNCUT.search(t)]
        out = [b"" if not t else None for t in texts]
        if cut:
            parts = [texts[i] for i in cut]
            for i, ids in zip(cut, self._looked_up(parts), strict=True):
                out[i] = ids
        for text, ids in zip(texts, out, strict=True):
            yield self.whole(text) if ids is None else ids

    def _looked_up(self, texts: list[str]) -> Iterator[bytes]:
        chars, starts, firsts = self._cuts([t.encode() for t in texts], texts, [plain(t) for t in texts])
        ends = np.append(starts[1:], len(chars))
        keys = _hashes(chars, starts, ends)
        if self.table.count > KEPT_PIECES:
            self.table = _Table()
        entry = self.table.find(keys)
        missing = np.flatnonzero(entry < 0)
        long: dict[int, bytes] = {}
        if len(missing):
            raw = chars.tobytes()
            short = missing[(ends - starts)[missing] <= KEPT_LENGTH]
            new, first = np.unique(keys[short], return_index=True)
            at = short[first]
            self.table.add(new, self._encode([raw[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist())]))
            entry[short] = self.table.find(keys[short])
            rest = missing[(ends - starts)[missing] > KEPT_LENGTH].tolist()
            long = dict(zip(rest, self._encode([raw[starts[i]:ends[i]].decode() for i in rest])))
        known = entry >= 0
        sizes = np.where(known, self.table.size[entry], 0)
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.table.ids[np.repeat(np.where(known, self.table.first[entry], 0) - total[:-1], sizes) + np.arange(total[-1])].tobytes()
        if not long:
            for low, high in zip(total[firsts[:-1]].tolist(), total[firsts[1:]].tolist()):
                yield ids[4 * low:4 * high]
            return
        gaps = np.array(sorted(long))
        for low, high in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
            parts, at = [], low
            for gap in gaps[np.searchsorted(gaps, low):np.searchsorted(gaps, high)].tolist():
                parts += [ids[4 * total[at]:4 * total[gap]], long[gap]]
                at = gap + 1
            yield b"".join([*parts, ids[4 * total[at]:4 * total[high]]])


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]
