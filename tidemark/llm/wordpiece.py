"""Token counts (10): greedy word pieces counted by a linear longest-match automaton.

The vocabulary is a trie of word-initial and continuing pieces.  Every state
holds a failure link (the state that reads on after the longest pieces of its
string are popped) and the number of pieces popped on the way, both computed
once; a word's greedy longest-match length then follows from one pass over its
characters, without building a piece.

Words are ``[^\\x20\\x09-\\x0D]+``.  A word that greedy matching can't split
counts as one unknown token.

Defined cases: null or wordless text has 0 words and 0 tokens; a word longer
than ``max_chars`` is one unknown token (as word-piece tokenizers do), and
without ``max_chars`` (None, as op10_token_counts has it) words of any length
are split; rows that repeat are counted each; ids may be null; extra columns
never enter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import only, tune

MOST = 500_000
#: longer words are counted each time, so that what is kept stays small
LONG = 100
_OPEN: dict[tuple, "Automaton"] = {}


@dataclass(frozen=True)
class Vocabulary:
    """Pieces from a sentencepiece file: those that begin with its word mark start words, the others continue them."""
    file: str = "piece_bpe_32k.model"
    mark: str = "▁"
    max_chars: int | None = 100


def load(v: Vocabulary) -> tuple[list[str], list[str]]:
    """(word-initial pieces, continuing pieces) without the mark, control and byte pieces."""
    import os

    import sentencepiece
    path = v.file
    if not os.path.isabs(path):
        import public_tokenizers
        path = public_tokenizers.path(path)
    s = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [s.id_to_piece(i) for i in range(s.get_piece_size()) if not (s.is_control(i) or s.is_unknown(i) or s.is_byte(i))]
    return ([x[len(v.mark):] for x in names if x.startswith(v.mark) and len(x) > len(v.mark)], [x for x in names if v.mark not in x])


class Automaton:
    """Trie with failure links and popped-piece counts."""

    def __init__(self, initial: list[str], inner: list[str], max_chars: int | None = 100):
        self.max_chars = max_chars
        # states 0: start of a word, 1: start of a continuation
        child: list[dict] = [{}, {}]
        ends = [False, False]
        for root, words in ((0, initial), (1, inner)):
            for w in words:
                s = root
                for c in w:
                    t = child[s].get(c)
                    if t is None:
                        t = child[s][c] = len(child)
                        child.append({})
                        ends.append(False)
                    s = t
                ends[s] = True
        n = len(child)
        fail, pops = [-1] * n, [0] * n
        queue = [0, 1]
        for s in queue:
            for c, t in child[s].items():
                if ends[t]:
                    fail[t], pops[t] = 1, 1      # the state's string is a piece: pop it, go on behind it
                else:
                    z, k = fail[s], pops[s]
                    while z >= 0 and c not in child[z]:
                        k += pops[z]
                        z = fail[z]
                    if z >= 0:
                        fail[t], pops[t] = child[z][c], k
                queue.append(t)
        self.child, self.fail, self.pops = child, fail, pops
        self.known: dict[str, int] = {}

    def count(self, word: str) -> int:
        """Pieces of a word; 1 (unknown) if it can't be split."""
        if self.max_chars is not None and len(word) > self.max_chars:
            return 1
        child, fail, pops = self.child, self.fail, self.pops
        s = n = 0
        for c in word:
            t = child[s].get(c)
            while t is None:
                n += pops[s]
                s = fail[s]
                if s < 0:
                    return 1
                t = child[s].get(c)
            s = t
        while s != 1:                            # pop what is left
            n += pops[s]
            s = fail[s]
            if s < 0:
                return 1
        return n


def automaton(v: Vocabulary) -> Automaton:
    if v not in _OPEN:
        _OPEN[v] = Automaton(*load(v), v.max_chars)
    return _OPEN[v]


def _words(text: str) -> list[str]:
    # str.split() knows more white space than the rule; texts without it take the quick way
    if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return text.split()
    return text.translate(_WHITE).split(" ")


_WHITE = {c: " " for c in range(9, 14)}


def _counts(v: Vocabulary):
    def run(batches):
        a = automaton(v)
        for batch in batches:
            words, tokens = [], []
            for t in batch.column(1).to_pylist():
                w = [x for x in _words(t) if x] if t else []
                if len(a.known) > MOST:
                    a.known.clear()
                got = list(map(a.known.get, w))
                if None in got:
                    for i, x in enumerate(w):
                        if got[i] is None:
                            got[i] = a.known.get(x)
                            if got[i] is None:
                                got[i] = a.count(x)
                                if len(x) <= LONG:
                                    a.known[x] = got[i]
                words.append(len(w))
                tokens.append(sum(got))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                                             names=["doc_id", "n_words", "n_tokens"])
    return run


def token_counts(docs: DataFrame, v: Vocabulary = Vocabulary(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_tokens per document. No shuffle."""
    tune(docs.sparkSession)
    d = only(docs, **{"doc_id": id_col, "text": text}).selectExpr("cast(doc_id as long) doc_id", "text")
    return d.mapInArrow(_counts(v), "doc_id long, n_words long, n_tokens long")
