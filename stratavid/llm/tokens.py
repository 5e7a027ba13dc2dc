"""Token ids of whole texts: the tokenizers library, asked once per distinct word."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

# Text handled at once; a longer document is handled alone.
SLICE_BYTES = 4 << 20
# Words remembered per worker process; beyond it the memory starts anew.
WORD_LIMIT = 400_000

# Lower-case letters of basic Latin and Latin-1, whose words are single pieces for the tokenizer.
_PLAIN = re.compile(r"[a-zß-öø-ÿ]+")
_UPPER = str.maketrans({chr(c): chr(c + 32) for c in [*range(0xC0, 0xD7), *range(0xD8, 0xDF)]})
_ASCII_UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})
# Punctuation right behind a Latin letter begins a piece, so a space between them changes nothing.
# The apostrophe may begin a contraction and stays.
_BEHIND = r"([a-zÀ-ÖØ-öø-ÿ])([!-&(-/:-@\[-`{-~])"


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of texts, with one library call per distinct word.

    The tokenizer never joins pieces across white space, so a text is the concatenation of its words.
    Words the library's normaliser could treat in context are given to it whole; plain words skip
    the normaliser and are encoded many at a time with the same model.

    The library cuts raw texts at its added tokens before anything else, so these are cut out first too.
    What is left has none, whatever it looks like once it is in lower case, and is encoded without them.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.full = Tokenizer.from_file(path)
        self.parts = Tokenizer.from_file(path)
        self.parts.encode_special_tokens = True
        self.plain = Tokenizer(self.full.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocab = self.full.get_vocab()
        self.size = max(vocab.values()) + 1
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for word, i in vocab.items() if word.endswith("</w>")]] = True
        self.added = {token.content: i for i, token in self.full.get_added_tokens_decoder().items()}
        self.cut = "|".join(map(re.escape, self.added))
        # An added token's word has an upper-case letter, which no other word has.
        self.marks = {content: f"T{i}" for content, i in self.added.items()}
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.ids = np.zeros(1 << 20, np.uint32)
        self.start = np.zeros(1 << 18, np.int64)
        self.length = np.zeros(1 << 18, np.int64)
        self.used = 0
        self._remember(list(self.marks.values()), np.array(list(self.added.values()), np.uint32), np.ones(len(self.marks), np.int64))

    def _remember(self, words: list[str], ids: np.ndarray, length: np.ndarray) -> None:
        n, k = len(self.slot), len(words)
        while n + k > len(self.start):
            self.start, self.length = np.resize(self.start, 2 * len(self.start)), np.resize(self.length, 2 * len(self.length))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.ids[self.used : self.used + len(ids)] = ids
        self.length[n : n + k] = length
        self.start[n : n + k] = self.used + np.cumsum(length) - length
        self.slot.update(zip(words, range(n, n + k)))
        self.used += len(ids)

    def _learn(self, words: list[str]) -> None:
        """Adds unseen words to the memory."""
        plain, odd, alias = [], [], []
        for word in words:
            if _PLAIN.fullmatch(word):
                plain.append(word)
            elif _PLAIN.fullmatch(low := word.translate(_UPPER)):
                alias.append((word, low))
            else:
                odd.append(word)
        plain += {low for _, low in alias}.difference(self.slot, plain)
        if plain:
            chunks = [" ".join(plain[i : i + 64]) for i in range(0, len(plain), 64)]
            found = self.plain.encode_batch_fast(chunks, add_special_tokens=False)
            ids = np.array([i for x in found for i in x.ids], np.uint32)
            ends = np.flatnonzero(self.ends[ids])  # one id that ends a word for each word
            self._remember(plain, ids, np.diff(ends, prepend=-1))
        if odd:
            found = [x.ids for x in self.parts.encode_batch_fast(odd, add_special_tokens=False)]
            ids = np.array([i for x in found for i in x], np.uint32)
            self._remember(odd, ids, np.array([len(x) for x in found], np.int64))
        if alias:
            same = np.array([self.slot[low] for _, low in alias])
            n, words = len(self.slot), [word for word, _ in alias]
            self._remember(words, np.zeros(0, np.uint32), self.length[same])
            self.start[n : n + len(words)] = self.start[same]

    def _lowered(self, texts: pa.Array) -> pa.Array:
        """The texts in lower case, with a mark between spaces for each added token of the raw text."""
        lowered = pc.ascii_lower(texts)
        if not self.added or not pc.any(has := pc.match_substring_regex(texts, self.cut)).as_py():
            return lowered
        marked = [
            "".join(f" {self.marks[p]} " if p in self.marks else p.translate(_ASCII_UPPER) for p in re.split(f"({self.cut})", t))
            for t in texts.filter(has).to_pylist()
        ]
        return pc.replace_with_mask(lowered, has, pa.array(marked, lowered.type))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and the offset of each text; null is empty."""
        spaced = pc.replace_substring_regex(self._lowered(pc.fill_null(texts, "")), _BEHIND, r"\1 \2")
        lists = pc.ascii_split_whitespace(spaced)
        words = lists.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.slot) > WORD_LIMIT:
            self._forget()
        slots = list(map(self.slot.get, distinct))
        if None in slots:
            self._learn([w for w, n in zip(distinct, slots) if n is None])
            slots = list(map(self.slot.get, distinct))
        at = np.array(slots, np.int64)[words.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int64)
        length = self.length[at]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.arange(total) + np.repeat(self.start[at] - (ends - length), length)]
        bounds = np.concatenate([[0], ends])
        word_offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        return ids, bounds[word_offsets]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of this worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``most`` bytes of text; a longer text comes alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    block = (np.cumsum(sizes.astype(np.int64)) - 1).clip(0) // most
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(sizes)]])
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        if hi > lo:
            yield batch.slice(int(lo), int(hi - lo))
