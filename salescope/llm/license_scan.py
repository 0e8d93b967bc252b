"""License scan: ordered signature rules over the words of every text.

A text is read as its words: A-Z lower-cased, a word being a run of ASCII
letters and digits and of all characters beyond ASCII.  Two things are sought.

Phrases: every place where the words of a phrase stand consecutively.

Detections: the matches of the signature rules (``license_rules``).  A rule's
pattern runs only on texts that hold all its keywords.  Of overlapping
detections, one that lies within another of a higher priority goes, and so does
one within a longer one of its own priority (of equal intervals the earlier
rule's stays); a partial overlap leaves both.

The score is the probability that a text speaks of a license at all, taking
each label that stays as independent evidence of its rule's weight.

Texts are read as bytes, in pieces that end at a word's end, so a very long text
takes memory of a few times its size; what is found is kept, all of it.  Edge
cases: a null text is empty and has no words and no labels; rows are scanned one
by one, so repeated ids and rows keep their rows; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescope.llm.common import map_texts
from salescope.llm.license_rules import RULES, WEIGHTS, Rule

#: Words of a phrase, and its label.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Bytes of a text that are split into words at a time.
PIECE = 1 << 20
_WORD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

FOUND = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("priority", T.IntegerType()),
                                  T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
PLACES = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType())]))


def word_pieces(text: str):
    """Lists of the words of ``text``, piece by piece."""
    raw = text.encode().translate(_WORD)
    at = 0
    while at < len(raw):
        end = len(raw)
        if end - at > PIECE:
            end = raw.find(b" ", at + PIECE)
            end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def suppressed(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """The (start, end, priority, rule) that lie within no other of a higher priority, nor a longer one of their own."""
    kept, reach = [], [-1] * len(WEIGHTS)
    # Whatever contains an interval comes before it: an earlier start, or the same one and a later end, priority or rule.
    for start, end, priority, rule in sorted(found, key=lambda d: (d[0], -d[1], -d[2], d[3])):
        if max(reach[priority:]) < end:
            kept.append((start, end, priority, rule))
        reach[priority] = max(reach[priority], end)
    return kept


class Scanner:
    """Finds phrases and rules in texts."""

    def __init__(self, rules: list[Rule], phrases: dict[str, str]):
        self.rules = rules
        self.phrases = [(p.encode(), frozenset(p.encode().split()), label) for p, label in phrases.items()]
        self.keywords = frozenset().union(*(r.keywords for r in rules), *(w for _, w, _ in self.phrases))

    def scan(self, text: str) -> tuple[int, list[tuple[str, int]], list[tuple[int, int, int, int]]]:
        """Number of words, places (label, start word) and detections (start word, end word, priority, rule)."""
        n, held = 0, set()
        for words in word_pieces(text):
            n += len(words)
            held |= self.keywords.intersection(words)
        rules = [k for k, r in enumerate(self.rules) if r.keywords <= held]
        phrases = [(p, label) for p, words, label in self.phrases if words <= held]
        if not rules and not phrases:
            return n, [], []
        whole = b" ".join(w for words in word_pieces(text) for w in words)
        blanks = np.flatnonzero(np.frombuffer(whole, dtype=np.uint8) == 32)
        places = []
        for phrase, label in phrases:
            at = whole.find(phrase)
            while at >= 0:
                end = at + len(phrase)
                if (at == 0 or whole[at - 1] == 32) and (end == len(whole) or whole[end] == 32):
                    places.append((label, int(np.searchsorted(blanks, at))))
                at = whole.find(phrase, at + 1)
        found = []
        for k in rules:
            for m in self.rules[k].pattern.finditer(whole):
                first, last = np.searchsorted(blanks, (m.start(), m.end() - 1))
                found.append((int(first), int(last) + 1, self.rules[k].priority, k))
        return n, places, suppressed(found)


def score(priorities: dict[str, int]) -> float:
    """Of the labels found, each with its highest priority."""
    rest = 1.0
    for label in sorted(priorities):
        rest *= 1 - WEIGHTS[priorities[label]]
    return 1 - rest


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] = RULES,
         phrases: dict[str, str] = PHRASES) -> DataFrame:
    """One row per input row: id, ``n_words``, ``places`` (label, start word), ``detections`` and ``score``.

    Detections are (label, priority, start word, end word), the end exclusive, words from 0.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))

    def make():
        scanner = Scanner(rules, phrases)

        def work(texts: list[str], _) -> dict:
            out = {"n_words": [], "places": [], "detections": [], "score": []}
            for text in texts:
                n, places, found = scanner.scan(text)
                best: dict[str, int] = {}
                for _, _, priority, k in found:
                    best[rules[k].label] = max(priority, best.get(rules[k].label, 0))
                out["n_words"].append(n)
                out["places"].append([{"label": label, "start": at} for label, at in sorted(places, key=lambda p: p[1])])
                out["detections"].append([{"label": rules[k].label, "priority": priority, "start": a, "end": b}
                                          for a, b, priority, k in found])
                out["score"].append(score(best))
            return out

        return work

    return map_texts(rows, make, {"n_words": T.LongType(), "places": PLACES, "detections": FOUND,
                                  "score": T.DoubleType()}).withColumnRenamed("_id", id_col)
