"""BPE encoding and decoding: backtracking encoder, offset-table decoder.

A word is encoded without replaying merges.  An Aho-Corasick automaton over the
vocabulary gives the longest token at a position; a token may follow another
only if the pair is compatible, that is, if merging the two tokens' text by
rank gives back just these two.  Where no token fits, the encoder steps back
and tries the next shorter one; a position found to be a dead end is never
entered again, so the time is linear in the word.  Compatibility is decided
once for a pair and kept in a table.

Decoding gathers bytes: all token strings lie in one buffer, and a table of
offsets gives each id its slice.

The vocabulary is a public ``tokenizers`` JSON file of word-end BPE (its path is
a parameter; the file is read on the driver and broadcast, a few MB).  Ids,
special tokens inside a text, normalisation (NFC, white space, lower case per
character) and the decoded text (token strings joined by spaces) are those of
the ``tokenizers`` library with ``add_special_tokens=False`` and
``skip_special_tokens=False``.

Edge cases: a null text is encoded as the empty one: no ids, empty decoded
text; very long texts are encoded whole; an empty table gives an empty result;
repeated rows are encoded alike; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata

import ahocorasick
import numpy as np
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from salescope.llm.common import map_texts

#: White space as the tokenizer file's normaliser sees it (fixed values).
_SPACE = "\t-\r \x85\xa0  -     　"
#: The file's word pattern, and the same for ASCII texts.
_WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+", regex.V0)
_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
#: Words that each half of a worker's memory of encoded words holds.
WORD_MEMORY = 100_000
#: Ids decoded at a time.
DECODE_IDS = 1 << 18


def byte_alphabet() -> dict[int, str]:
    """The printable character that byte-level BPE writes for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def load_vocabulary(path: str) -> dict:
    """What the encoder needs of a tokenizer file: vocabulary, merges, special tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    return {"vocab": model["vocab"], "merges": [tuple(m) for m in model["merges"]],
            "end": model["end_of_word_suffix"],
            "special": {t["content"]: t["id"] for t in spec["added_tokens"]}}


class Encoder:
    """Encodes words of byte-level symbols; the last symbol of a word carries the end mark."""

    def __init__(self, vocabulary: dict):
        end, vocab = vocabulary["end"], vocabulary["vocab"]
        alphabet = byte_alphabet()
        # Inside, a symbol is one character: the byte, or 256 + the byte at a word's end.
        inner = {c: chr(b) for b, c in alphabet.items()}

        def own(token: str) -> str:
            last = token.endswith(end) and token != end
            chars = [inner[c] for c in (token[: -len(end)] if last else token)]
            if last:
                chars[-1] = chr(256 + ord(chars[-1]))
            return "".join(chars)

        self.ids = {own(t): i for t, i in vocab.items()}
        self.texts = {i: t for t, i in self.ids.items()}
        self.joined: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        for rank, (a, b) in enumerate(vocabulary["merges"]):
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self.joined[left, right] = whole
            self.halves.setdefault(whole, (left, right))
            self.rank.setdefault(whole, rank)
        self.shorter: dict[int, int | None] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        # A token whose own text merges to something else never occurs.
        never: set[int] = set()
        for whole, (left, right) in self.halves.items():  # in order of rank: halves come first
            if left in never or right in never or not self._border_open(left, right, (self.rank[whole], 1)):
                never.add(whole)
        self.ids = {t: i for t, i in self.ids.items() if i not in never}
        self.longest = ahocorasick.Automaton()
        for text, i in self.ids.items():
            self.longest.add_word(text, i)
        self.longest.make_automaton()

    def prefix(self, token: int) -> int | None:
        """The longest token that is a proper prefix of ``token``."""
        if token not in self.shorter:
            text = self.texts[token]
            self.shorter[token] = next((i for n in range(len(text) - 1, 0, -1)
                                        if (i := self.ids.get(text[:n])) is not None), None)
        return self.shorter[token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the text of both, merged by rank, ends as just these two tokens."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            known = self.pairs[key] = (key not in self.joined
                                       and self._border_open(left, right, (len(self.rank), 1)))
        return known

    def _border_open(self, left: int, right: int, before: tuple[int, int]) -> bool:
        """Whether no merge earlier than ``before`` crosses the border of two tokens.

        Going back in time, the later of the merges that made the tokens at the
        border is undone; if the parts then at the border could merge, and that
        merge comes before the one undone last, it would have crossed.  At equal
        rank the merge further left happens first.
        """
        rank, halves = self.rank, self.halves
        while True:
            a, b = rank.get(left, -1), rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                before, left = (a, 1), halves[left][1]
            else:
                before, right = (b, 2), halves[right][0]
            whole = self.joined.get((left, right))
            if whole is not None and (rank[whole], 1) < before:
                return False

    def encode(self, word: str) -> list[int]:
        """Ids of one word (own symbols)."""
        whole = self.ids.get(word)
        if whole is not None and whole not in self.halves:
            return [whole]
        size, out, pos = len(word), [], 0
        dead = bytearray(size + 1)
        token = self._match(word, 0)
        while True:
            end = pos + len(self.texts[token])
            if not dead[end] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                pos = end
                if pos == size:
                    return out
                token = self._match(word, pos)
                continue
            token = self.prefix(token)
            while token is None:
                dead[pos] = 1
                token = out.pop()
                pos -= len(self.texts[token])
                token = self.prefix(token)

    def _match(self, word: str, pos: int) -> int:
        return next(self.longest.iter_long(word, pos))[1]

    def encode_text(self, word: str) -> list[int]:
        """Ids of one word of text."""
        raw = word.encode("utf-8")
        return self.encode(raw[:-1].decode("latin-1") + chr(256 + raw[-1]))


class WordIds(dict):
    """Word -> its ids as little-endian bytes; remembers a bounded number of words."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder, self.old = encoder, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = np.array(self.encoder.encode_text(word), dtype="<u4").tobytes()
        if len(word) <= 32:
            if len(self) >= WORD_MEMORY:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids


class TextEncoder:
    """Texts to ids, as bytes of little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: dict):
        self.words = WordIds(Encoder(vocabulary))
        self.special = {t: np.array([i], dtype="<u4").tobytes() for t, i in vocabulary["special"].items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None

    def _plain(self, text: str) -> bytes:
        if text.isascii():
            words = _ASCII_WORDS.findall(text.lower())
        else:
            text = unicodedata.normalize("NFC", text)
            # Lower case goes character by character: no final form of sigma.
            words = _WORDS.findall(text.replace("Σ", "σ").lower())
        return b"".join(map(self.words.__getitem__, words))

    def encode(self, text: str) -> bytes:
        if self.cut is None or not any(t in text for t in self.special):
            return self._plain(text)
        return b"".join(self.special[part] if part in self.special else self._plain(part)
                        for part in self.cut.split(text) if part)


class Decoder:
    """Ids to text through one buffer of token strings and a table of offsets."""

    def __init__(self, vocabulary: dict):
        tokens = {**{i: t for t, i in vocabulary["vocab"].items()},
                  **{i: t for t, i in vocabulary["special"].items()}}
        strings = [(tokens.get(i, "") + " ").encode("utf-8") for i in range(max(tokens) + 1)]
        self.offsets = np.zeros(len(strings) + 1, dtype=np.int64)
        np.cumsum([len(s) for s in strings], out=self.offsets[1:])
        self.buffer = np.frombuffer(b"".join(strings), dtype=np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the token strings joined by one space."""
        out = []
        for at in range(0, len(ids), DECODE_IDS):
            part = ids[at:at + DECODE_IDS]
            starts = self.offsets[part]
            sizes = self.offsets[part + 1] - starts
            ends = np.cumsum(sizes)
            gather = np.arange(ends[-1], dtype=np.int64) + np.repeat(starts - (ends - sizes), sizes)
            out.append(self.buffer[gather].tobytes())
        return b"".join(out)[:-1]


_OUTPUTS = {
    "n_tokens": T.LongType(), "ids": T.ArrayType(T.IntegerType(), False), "ids_sha256": T.StringType(),
    "decoded": T.StringType(), "decoded_sha256": T.StringType(),
}
_LOADED: dict[str, tuple[TextEncoder, Decoder]] = {}


def _tools(shared: Broadcast, key: str) -> tuple[TextEncoder, Decoder]:
    """Encoder and decoder of this worker, built once from the broadcast vocabulary with digest ``key``."""
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = (TextEncoder(shared.value), Decoder(shared.value))
    return _LOADED[key]


def encode_decode(docs: DataFrame, vocabulary_path: str, outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded"),
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id and the named ``outputs`` (any of n_tokens, ids, ids_sha256,
    decoded, decoded_sha256); decoded is made from the ids."""
    vocabulary = load_vocabulary(vocabulary_path)
    digest = hashlib.sha256(json.dumps(vocabulary).encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    wants = set(outputs)

    def make():
        encoder, decoder = _tools(shared, digest)

        def work(texts: list[str | None], _) -> dict:
            found: dict[str, list] = {k: [] for k in outputs}
            for text in texts:
                raw = encoder.encode(text or "")
                ids = np.frombuffer(raw, dtype="<u4")
                if "n_tokens" in wants:
                    found["n_tokens"].append(len(ids))
                if "ids" in wants:
                    found["ids"].append(ids.astype(np.int32))
                if "ids_sha256" in wants:
                    found["ids_sha256"].append(hashlib.sha256(raw).hexdigest())
                if wants & {"decoded", "decoded_sha256"}:
                    back = decoder.decode(ids)
                    if "decoded" in wants:
                        found["decoded"].append(back.decode("utf-8"))
                    if "decoded_sha256" in wants:
                        found["decoded_sha256"].append(hashlib.sha256(back).hexdigest())
            return found

        return work

    return map_texts(rows, make, {k: _OUTPUTS[k] for k in outputs}).withColumnRenamed("_id", id_col)
