"""Byte-pair encoding of many words at once: rank-synchronous merging of ragged arrays.

A batch of pre-tokens is one flat array of symbol ids plus the word each symbol belongs to. In each
round every word applies its own lowest-rank pair, all words simultaneously, until no word has a pair
left; the surviving symbols are the tokens. Rounds are as many as the longest chain of merges in one
word, and each works on whole arrays.

Pre-tokens follow the tokenizer file: NFC, white space, lower case, then contractions, letter runs,
single digits and runs of anything else. For texts of Latin letters and common punctuation one regular
expression over the lower-cased text does this; all other texts go through the normalizer and
pre-tokenizer of the file's own library. Both give the same words.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np

NO_RANK = np.int64(1) << 40
# Characters per step of one text, and words held in memory before the vocabulary of a task starts anew.
STEP_CHARS = 1 << 20
HELD_WORDS = 400_000

# Texts of these characters alone take the fast way: normalization leaves them as they are.
PLAIN = "\u0000-ɏ‐-‧‰-⁞€"


def _char_classes() -> tuple[str, str, str]:
    """Letters, numbers and white space among the plain characters, as character-class text."""
    chars = [chr(c) for c in range(0x250)]
    letters = "".join(re.escape(c) for c in chars if unicodedata.category(c)[0] == "L")
    numbers = "".join(re.escape(c) for c in chars if unicodedata.category(c)[0] == "N")
    # The Unicode white space among them (the separators 1C to 1F are not white space).
    return letters, numbers, "\t\n\x0b\x0c\r \x85\xa0"


class PairTable:
    """Ranks of symbol pairs: an open hash table that looks up whole arrays."""

    BITS = 19

    def __init__(self, pairs: np.ndarray, ranks: np.ndarray):
        self.keys = np.full(1 << self.BITS, -1, dtype=np.int64)
        self.values = np.full(1 << self.BITS, NO_RANK, dtype=np.int64)
        at = self._slot(pairs)
        while len(pairs):
            free = np.flatnonzero(self.keys[at] < 0)
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.keys[at[put]], self.values[at[put]] = pairs[put], ranks[put]
            left = np.ones(len(pairs), dtype=bool)
            left[put] = False
            pairs, ranks, at = pairs[left], ranks[left], (at[left] + 1) & ((1 << self.BITS) - 1)

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.BITS)).astype(np.int64)

    def ranks(self, pairs: np.ndarray) -> np.ndarray:
        """The rank of every pair, ``NO_RANK`` for pairs that aren't in the table."""
        at = self._slot(pairs)
        key, rank = self.keys[at], self.values[at]
        wrong = np.flatnonzero((key != pairs) & (key >= 0))
        rank[key < 0] = NO_RANK
        step = 0
        while len(wrong):
            step += 1
            next_ = (at[wrong] + step) & ((1 << self.BITS) - 1)
            key = self.keys[next_]
            rank[wrong] = np.where(key == pairs[wrong], self.values[next_], NO_RANK)
            wrong = wrong[(key != pairs[wrong]) & (key >= 0)]
        return rank


class Numbers(dict):
    """Numbers words in the order in which they are first asked for, and lists those in ``fresh``."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number


class WordBpe:
    """Token ids and token counts of texts, as the library gives them for the tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocab = spec["model"], spec["model"]["vocab"]
        self.end = model["end_of_word_suffix"]
        self.specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special = re.compile("(" + "|".join(re.escape(x) for x in self.specials) + ")")
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        pairs = np.array([vocab[a] << 20 | vocab[b] for a, b in merges], dtype=np.int64)
        ranks = np.arange(len(pairs), dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        self.table = PairTable(pairs, ranks)
        self.made = made  # by rank
        glyphs = _byte_glyphs()
        self.inner = np.array([vocab[g] for g in glyphs], dtype=np.int64)
        self.last = np.array([vocab[g + self.end] for g in glyphs], dtype=np.int64)
        letters, numbers, spaces = _char_classes()
        self.plain = re.compile(f"[{PLAIN}]*")
        # The contractions of the tokenizer file.
        self.words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{spaces}{letters}{numbers}]+")
        self._clear()

    def _clear(self) -> None:
        self.known = Numbers()
        self.ids = np.zeros(0, dtype=np.int32)
        self.starts = np.zeros(1, dtype=np.int64)

    def pre_tokens(self, text: str) -> list[str]:
        """The words of a text without special strings."""
        if self.plain.fullmatch(text):
            return self.words.findall(text.lower())
        clean = self.library.normalizer.normalize_str(text)
        glyphs = self.library.pre_tokenizer.pre_tokenize_str(clean)
        return [_glyph_bytes(word).decode() for word, _ in glyphs]  # it shows words as glyphs of their bytes

    def _symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = [w.encode() for w in words]
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        codes = np.frombuffer(b"".join(raw), dtype=np.uint8)
        symbols = self.inner[codes]
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.last[codes[ends]]
        return symbols, np.repeat(np.arange(len(raw)), sizes)

    def merge(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge every word's lowest-rank pair, all words at once, until none is left."""
        done_symbols, done_owner = [], []
        while len(symbols):
            rank = self._pair_ranks(symbols, owner)
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.r_[first, len(symbols)])
            mine = np.repeat(lowest, sizes)
            open_ = mine < NO_RANK
            done_symbols.append(symbols[~open_])
            done_owner.append(owner[~open_])
            symbols, owner, rank, mine = symbols[open_], owner[open_], rank[open_], mine[open_]
            if not len(symbols):
                break
            hit = np.flatnonzero(rank == mine)
            # Of pairs that overlap, as in "aaa", every other one counts, from the left.
            chain = np.r_[True, (hit[1:] != hit[:-1] + 1)]
            place = np.arange(len(hit)) - np.maximum.accumulate(np.where(chain, np.arange(len(hit)), 0))
            hit = hit[place % 2 == 0]
            symbols[hit] = self.made[rank[hit]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[hit + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        symbols, owner = np.concatenate(done_symbols or [symbols]), np.concatenate(done_owner or [owner])
        order = np.argsort(owner, kind="stable")
        return symbols[order], owner[order]

    def _pair_ranks(self, symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """The rank of the pair that starts at each symbol."""
        rank = np.full(len(symbols), NO_RANK)
        if len(symbols) > 1:
            rank[:-1] = self.table.ranks(symbols[:-1] << 20 | symbols[1:])
            rank[:-1][owner[:-1] != owner[1:]] = NO_RANK
        return rank

    def _learn(self) -> None:
        """Merge the words that were numbered since the last call."""
        words = self.known.fresh
        if words:
            symbols, owner = self.merge(*self._symbols(words))
            counts = np.bincount(owner, minlength=len(words))
            self.ids = np.concatenate([self.ids, symbols.astype(np.int32)])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])
            self.known.fresh = []

    def _steps(self, text: str) -> Iterator[tuple[list[str], int]]:
        """Words of a text in steps of bounded size, and specials between them (-1: none)."""
        for piece in self.special.split(text) if "<|" in text else [text]:
            if piece in self.specials:
                yield [], self.specials[piece]
                continue
            begin = 0
            while begin < len(piece):
                end = begin + STEP_CHARS
                if end < len(piece):  # words don't reach across a blank
                    cut = piece.find(" ", end)
                    end = cut if cut >= 0 else len(piece)
                yield self.pre_tokens(piece[begin:end]), -1
                begin = end

    def places(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray, int]]:
        """(text number, places of its words in ``starts``, special id or -1), in reading order.

        New words are merged together for as many texts as fit one step.
        """
        held, size = [], 0
        for number, text in enumerate(texts):
            for words, special in self._steps(text):
                place = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
                held.append((number, place, special))
                size += len(words)
                if size > STEP_CHARS // 4:
                    self._learn()
                    yield from held
                    held, size = [], 0
                    if len(self.known) > HELD_WORDS:
                        self._clear()
        self._learn()
        yield from held

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        total = np.zeros(len(texts), dtype=np.int64)
        for number, at, special in self.places(texts):
            total[number] += (self.starts[at + 1] - self.starts[at]).sum() + (special >= 0)
        return total

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text."""
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        for number, at, special in self.places(texts):
            if special >= 0:
                parts[number].append(np.array([special], dtype=np.int32))
            elif len(at):
                begin, size = self.starts[at], self.starts[at + 1] - self.starts[at]
                shift = np.repeat(begin - np.r_[0, np.cumsum(size)[:-1]], size)
                parts[number].append(self.ids[np.arange(len(shift)) + shift])
        empty = np.zeros(0, dtype=np.int32)
        return [np.concatenate(p) if p else empty for p in parts]


def _byte_glyphs() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    glyphs, spare = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in glyphs:
            glyphs[b] = chr(spare)
            spare += 1
    return [glyphs[b] for b in range(256)]


_BYTE_OF_GLYPH = {g: b for b, g in enumerate(_byte_glyphs())}


def _glyph_bytes(word: str) -> bytes:
    return bytes(_BYTE_OF_GLYPH[g] for g in word)
