"""Byte-pair encoding with word ends by backtracking, and decoding from
an offset table, for tokenizer files of the "word BPE" kind.

Encoding.  A word is a string of symbols (one per UTF-8 byte; the last
one marked as a word end).  An Aho-Corasick automaton over all tokens
finds, in one pass over the word, the longest token that starts at each
position.  The encoder walks from the left and takes the longest token
that is *compatible* with the token before it: two tokens are compatible
if merging their joined symbols by rank leaves exactly these two.  Where
no prefix token of the longest one fits, the position is marked dead and
the walk steps back over the last token.  A position dies at most once,
so the walk is linear in the word, and the tokens are those that
rank-ordered merging yields.  Answers of the compatibility test are kept
in a table.

Words repeat, so their ids are kept in a bounded dictionary (emptied when
full; that changes the time only).  ``encode_all`` cuts many texts at once
by the classes of their characters and looks each different word up once.

Decoding.  The strings of all tokens lie in one byte buffer; token t is
``buffer[offset[t]:offset[t + 1]]``, so a document is one gather.
"""

from __future__ import annotations

import functools
import json
import re
import struct

import ahocorasick
import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

KEPT_WORDS = 200_000  # also the answers of the compatibility test
KEPT_LENGTH = 64
WORD_END = 0x10000  # added to the last symbol's code point

# Letters, digits and white space below U+0180; anything beyond goes
# through the tokenizer's own normalizer and splitter.
_LETTERS = "a-zªµºÀ-ÖØ-öø-ſ"
_NUMBERS = "0-9²³¹¼½¾"
_SPACES = "\t-\r \x85\xa0"
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+")
_BEYOND = re.compile("[^\x00-ſ]|[\x1c-\x1f]")
_SPACE_RUN = re.compile("[^\\S\x1c-\x1f]+")


# Of each character below U+0180: its lower case and its class.  Others,
# and the few whose lower case is longer or that split otherwise, are BEYOND.
LETTER, NUMBER, SPACE, OTHER, BEYOND = range(5)


def _classes() -> tuple[np.ndarray, np.ndarray]:
    lower, kinds = np.zeros(1 << 16, np.uint16), np.full(1 << 16, BEYOND, np.uint8)
    patterns = [re.compile(f"[{c}]") for c in (_LETTERS, _NUMBERS, _SPACES)]
    for code in range(0x180):
        c = chr(code).lower()
        if len(c) == 1 and not _BEYOND.search(chr(code)):
            lower[code] = ord(c)
            kinds[code] = next((k for k, p in enumerate(patterns) if p.match(c)), OTHER)
    return lower, kinds


_LOWER, _KINDS = _classes()
_ENDINGS = [(e, [ord(c) for c in e]) for e in ("s", "t", "re", "ve", "m", "ll", "d")]
SLICE_CHARS = 2_000_000  # split at once; longer texts are split alone


def byte_symbols() -> str:
    """The character that stands for each byte: itself if it is visible
    Latin-1, else the next free one from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return "".join(chr(b if b in visible else next(spare)) for b in range(256))


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordCache(dict):
    """Ids by normalized word; at most ``KEPT_WORDS`` of words of at most
    ``KEPT_LENGTH`` characters stay in memory."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(word) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = ids
        return ids


class WordSplitter:
    """Cuts texts into special tokens and normalized words as the
    tokenizer file says, and joins the words' ids, which ``word_ids``
    of a subclass finds."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        self.symbol = byte_symbols()
        self.table = {i: ord(c) for i, c in enumerate(self.symbol)}
        self.special = {t["content"]: t["id"] for t in self.spec.get("added_tokens", [])}
        self.special_cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = self.library.normalizer, self.library.pre_tokenizer
        self.cache = WordCache(self.word_bytes)
        self.plain_cache = WordCache(lambda word: self.word_bytes(word.decode("utf-16-le")))

    def word_ids(self, symbols: str) -> list[int]:
        raise NotImplementedError

    def word_bytes(self, word: str) -> bytes:
        if not (word.isascii() and word.isprintable()):
            word = word.encode().decode("latin-1").translate(self.table)
        return _packed(self.word_ids(word))

    def words(self, part: str) -> list[bytes]:
        """Ids of each word of a part without special tokens."""
        if not _BEYOND.search(part):
            return [*map(self.cache.__getitem__, _SPLIT.findall(part.lower()))]
        out = []
        for piece in _SPACE_RUN.split(part):  # no word spans white space
            if not _BEYOND.search(piece):
                out += map(self.cache.__getitem__, _SPLIT.findall(piece.lower()))
            else:
                found = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(piece))
                out += [_packed(self.word_ids(w)) for w, _ in found]
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if not (self.special_cut and "<" in text):
            return b"".join(self.words(text))
        out = []
        for part in self.special_cut.split(text):
            out += [_packed([self.special[part]])] if part in self.special else self.words(part)
        return b"".join(out)


    def encode_all(self, texts: list[str]) -> list[bytes]:
        """As ``encode`` for each text, but split in one pass over many."""
        out, part, chars = [], [], 0
        for text in texts:
            part.append(text)
            chars += len(text)
            if chars >= SLICE_CHARS:
                out += self._encode_part(part)
                part, chars = [], 0
        return out + self._encode_part(part)

    def _encode_part(self, texts: list[str]) -> list[bytes]:
        found: list = [None] * len(texts)
        plain = []
        for i, text in enumerate(texts):
            if len(text) > SLICE_CHARS or self.special_cut and "<" in text and self.special_cut.search(text):
                found[i] = self.encode(text)
            else:
                plain.append(i)
        coded = [texts[i].encode("utf-16-le") for i in plain]
        ends = np.cumsum([len(c) // 2 + 1 for c in coded])
        codes = np.frombuffer(b" \0".join(coded) + b" \0", np.uint16)
        kinds = _KINDS.take(codes)
        beyond = np.zeros(len(plain), bool)
        beyond[np.searchsorted(ends, np.flatnonzero(kinds == BEYOND), "right")] = True
        sizes, ids = self._plain_ids(codes, kinds, ends)
        at = 0
        for i, size, other in zip(plain, sizes, beyond.tolist()):
            found[i] = self.encode(texts[i]) if other else ids[at:at + size]
            at += size
        return found

    def _plain_ids(self, codes: np.ndarray, kinds: np.ndarray, ends: np.ndarray) -> tuple[list[int], bytes]:
        """Bytes of ids of each text, and all ids, of the texts that end at
        ``ends``, each closed by a space; ids of what lies beyond are 0 long."""
        codes = _LOWER.take(codes)
        first = np.empty(len(kinds), bool)  # whether a word, or a run of spaces, begins here
        first[:1] = True
        np.not_equal(kinds[1:], kinds[:-1], out=first[1:])
        first |= kinds == NUMBER
        quote = np.flatnonzero((codes == ord("'")) & first)
        for ending, letters in _ENDINGS:
            # An apostrophe that begins a word takes an ending with it; every text closes with a space.
            at = quote
            for place, letter in enumerate(letters, 1):
                at = at[codes.take(at + place, mode="clip") == letter]
            first[at + 1] = False
            first[at + 1 + len(ending)] = True
            quote = quote[first[quote + 1]]
        starts = np.flatnonzero(first)
        keep = np.isin(kinds.take(starts), (LETTER, NUMBER, OTHER))
        lengths = np.diff(starts, append=len(codes))[keep]
        starts = starts[keep]
        # The words' characters one after another, as Arrow strings of two bytes a character.
        inside = (kinds != SPACE) & (kinds != BEYOND)
        offsets = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(2 * lengths, out=offsets[1:])
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(codes[inside])])
        words = words.dictionary_encode()
        known = [*map(self.plain_cache.__getitem__, words.dictionary.to_numpy(zero_copy_only=False).tolist())]
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        begin = np.cumsum(size) - size
        word = words.indices.to_numpy()
        size, begin = size.take(word), begin.take(word)
        total = np.cumsum(size)
        place = np.repeat(begin - (total - size), size)
        place += np.arange(len(place))
        ids = np.frombuffer(b"".join(known), np.uint32).take(place)
        total = np.concatenate([[0], total])[np.searchsorted(starts, ends)]
        return (4 * np.diff(total, prepend=0)).tolist(), ids.tobytes()


class LibraryWords(WordSplitter):
    """Words' ids by the model of the tokenizers library."""

    def word_ids(self, word: str) -> list[int]:
        return [t.id for t in self.library.model.tokenize(word)]


class WordBpe(WordSplitter):
    """Backtracking encoder and offset-table decoder."""

    def __init__(self, path: str):
        super().__init__(path)
        spec, model = self.spec, self.spec["model"]
        self.suffix = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]

        # Numbered by rank: symbols first, then merges in their order.
        index: dict[str, int] = {}
        for c in [*self.symbol, *(c + self.suffix for c in self.symbol)]:
            if c not in vocab:
                raise ValueError(f"symbol {c!r} is not in the vocabulary")
            index[c] = len(index)
        left, right = list(range(len(index))), list(range(len(index)))
        self.joined: dict[tuple[int, int], int] = {}
        for a, b in merges:
            pair = index[a], index[b]
            whole = a + b
            if whole not in index:
                index[whole] = len(left)
                left.append(pair[0])
                right.append(pair[1])
            self.joined.setdefault(pair, index[whole])
        self.left, self.right = left, right
        self.ids = [vocab[t] for t in index]
        strings = [self._symbols(t) for t in index]
        self.length = list(map(len, strings))
        number = {s: i for i, s in enumerate(strings)}
        self.shorter = [next((number[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in number), -1)
                        for s in strings]
        self.automaton = ahocorasick.Automaton()
        for s, i in number.items():
            self.automaton.add_word(s, i)
        self.automaton.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}

        by_id = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        # The library joins the tokens' strings by a space if the file names no decoder.
        if spec.get("decoder") is not None:
            raise ValueError("only files without a decoder are supported")
        stored = [(by_id.get(i, "") + " ").encode() for i in range(max(by_id) + 1)]
        self.buffer = np.frombuffer(b"".join(stored), np.uint8)
        self.offset = np.concatenate([[0], np.cumsum([len(s) for s in stored])]).astype(np.int64)

    def _symbols(self, token: str) -> str:
        if token.endswith(self.suffix) and len(token) > len(self.suffix):
            body = token[: -len(self.suffix)]
            return body[:-1] + chr(ord(body[-1]) + WORD_END)
        return token

    def compatible(self, a: int, b: int) -> bool:
        """Whether no merge would join the end of ``a`` with the start of
        ``b`` before ``a`` and ``b`` themselves are complete.  Undoes the
        later of the two tokens' last merges until both are symbols."""
        known = self.fits.get((a, b))
        if known is not None:
            return known
        x, y, bound, answer = a, b, len(self.left), True
        while True:
            made = self.joined.get((x, y))
            if made is not None and made < bound:
                answer = False
                break
            # A merge on the left wins a tie of ranks, as it stands first.
            if x > y:
                part, bound = self.right[x], x
                if part == x:
                    break
                x = part
            else:
                part, bound = self.left[y], y + 1
                if part == y:
                    if self.right[x] == x:
                        break
                    bound = x
                    x = self.right[x]
                else:
                    y = part
        if len(self.fits) >= KEPT_WORDS:
            self.fits.clear()
        self.fits[a, b] = answer
        return answer

    def encode_word(self, word: str) -> list[int]:
        n, length = len(word), self.length
        longest = [-1] * n
        for end, token in self.automaton.iter(word):
            longest[end + 1 - length[token]] = token  # later ends are longer
        out: list[int] = []
        dead: set[int] = set()
        at, token, before = 0, longest[0], -1
        while at < n:
            while token >= 0:
                end = at + length[token]
                if end not in dead and (before < 0 or self.compatible(before, token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                at, before = end, token
                token = longest[at] if at < n else -1
            else:
                dead.add(at)
                before = out.pop()
                at -= length[before]
                token = self.shorter[before]
                before = out[-1] if out else -1
        return out

    def word_ids(self, word: str) -> list[int]:
        return [self.ids[t] for t in self.encode_word(word[:-1] + chr(ord(word[-1]) + WORD_END))]

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 text of the ids, gathered through the offset table."""
        t = np.frombuffer(ids, "<u4").astype(np.int64)
        if not len(t):
            return b""
        start = self.offset[t]
        length = self.offset[t + 1] - start
        first = np.cumsum(length) - length
        at = np.arange(int(length.sum())) + np.repeat(start - first, length)
        return self.buffer[at[:-1]].tobytes()


@functools.lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    """One instance for each Python worker."""
    return WordBpe(path)


@functools.lru_cache(maxsize=2)
def library_words(path: str) -> LibraryWords:
    return LibraryWords(path)
