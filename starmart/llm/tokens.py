"""Token ids of a public byte-level BPE vocabulary, inside tasks.

A byte-level BPE cuts a text into pieces (a word with the space before it, a run of punctuation, ...) and merges
bytes within a piece only. A text without two adjacent spaces can be cut before every space, so the ids of a word
are computed once and looked up afterwards. A text with two adjacent spaces goes to the ``tokenizers`` library whole.
Both give the ids of the whole text.

New words are encoded with the rank file of the same vocabulary, where there is one next to it: that is several
times as fast and gives the same ids for words in Latin letters. Other words, very long ones and those that may hold
a special token go to the ``tokenizers`` library.
"""

from __future__ import annotations

import os

import numpy as np

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
CACHED_WORDS = 1 << 17
LATIN_END = "\u0250"  # below it, all libraries agree on what a letter is
LONG_WORD = 256
_LOADED: dict[str, "WordTokenizer"] = {}


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def rank_encoder(path: str):
    """An encoder from the rank file beside ``path``, or None."""
    ranks = path.removesuffix(".json") + ".tiktoken"
    if not os.path.exists(ranks):
        return None
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})


class WordTokenizer:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ranks = rank_encoder(path)
        self.words: dict[str, bytes] = {}  # ids of " " + word, little-endian unsigned 32-bit
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        names = (self.tokenizer.id_to_token(i) or "" for i in range(size))
        self.after_space = np.array([name.startswith("\u0120") for name in names])  # how byte 0x20 is written

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, missing: list[str]) -> None:
        """Encode new words in one text. Each begins with the only id of its ids that starts with a space."""
        text = " " + " ".join(missing)
        if self.ranks and max(text) < LATIN_END and "<|" not in text and max(map(len, missing)) < LONG_WORD:
            ids = np.array(self.ranks.encode_ordinary(text), "<u4")
        else:
            ids = self._ids(text)
        starts = (4 * np.flatnonzero(self.after_space[ids])).tolist()
        data = ids.tobytes()
        self.words.update(zip(missing, [data[a:b] for a, b in zip(starts, [*starts[1:], len(data)])], strict=True))

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if "  " in text:
            return self._ids(text).tobytes()
        first, *rest = text.split(" ")
        found = list(map(self.words.get, rest))
        if None in found:
            missing = list(dict.fromkeys([w for w, ids in zip(rest, found) if ids is None]))
            if len(self.words) + len(missing) > CACHED_WORDS:
                self.words.clear()
                missing = list(dict.fromkeys(rest))
            # an empty last word is the space that ends the text
            if "" in missing:
                missing.remove("")
                self.words[""] = self._ids(" ").tobytes()
            if missing:
                self._learn(missing)
            found = [self.words[w] for w in rest]
        head = self._ids(first).tobytes() if first else b""
        return head + b"".join(found)


def tokenizer(path: str) -> WordTokenizer:
    """One tokenizer per Python worker and vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]
