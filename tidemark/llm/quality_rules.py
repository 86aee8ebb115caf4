"""Quality rules (9): line-first cleaning of documents.

Every line is judged alone by a punctuation, a navigation and a boilerplate
rule; failing lines are removed; a document that loses too much of its text is
rejected, as is one that fails the base rules on its whole text.

Defined cases: a null or empty text has no words, fails the base rules
(``n_words < min_words``) and is rejected; rows that repeat are judged alike,
each on its own; blank lines are neither judged nor counted; the input's other
columns pass through :func:`clean_documents` untouched, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import give_back, only, tune

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

#: a line that ends a sentence, in the scripts' own marks, perhaps behind a quote, bracket or markup end
TERMINAL = r"""[.!?:;…。！？؟।]["'”’»)\]}*_]*$"""
#: words of site navigation; a short line made of them alone is a menu
NAVIGATION_WORDS = ("home", "next", "previous", "prev", "menu", "login", "logout", "sign", "in", "up", "out",
                    "register", "search", "contact", "about", "us", "faq", "help", "sitemap", "share", "tweet",
                    "print", "back", "to", "top", "more", "read", "skip", "content", "click", "here")
#: phrases of page furniture
BOILERPLATE = ("lorem ipsum", "javascript", "cookie policy", "use cookies", "uses cookies", "accept cookies",
               "privacy policy", "terms of use", "terms of service", "all rights reserved", "subscribe to our",
               "sign up for our", "page not found", "enable your browser")


@dataclass(frozen=True)
class LineRules:
    """Parameters of the line rules and of the verdict."""
    min_words: int = 50
    max_repeat_pct: int = 50      # repeated-window words, per cent of all words
    max_lost_share: float = 0.4   # of the word characters
    separators: str = "|•·»›→"
    max_separator_share: float = 0.2   # separators per word of a line
    max_shout_share: float = 0.5       # words of a line that end in two or more '!' or '?'
    max_symbol_share: float = 0.3      # characters of [#*$%&|<>] per word of a line
    long_line_words: int = 12          # shorter lines may lack a terminal mark (headings, list items)
    navigation: tuple = NAVIGATION_WORDS
    boilerplate: tuple = BOILERPLATE
    terminal: str = field(default=TERMINAL)


class LineJudge:
    """The three rules, compiled once per task."""

    def __init__(self, r: LineRules):
        self.r = r
        self.terminal = re.compile(r.terminal)
        self.boiler = re.compile("|".join(map(re.escape, r.boilerplate))) if r.boilerplate else None
        self.seps = re.compile(f"[{re.escape(r.separators)}]") if r.separators else None
        self.nav = frozenset(r.navigation)
        self.shout = re.compile(r"[!?]{2,}(?=\s|$)")
        self.symbol = re.compile(r"[#*$%&|<>]")

    def punctuation(self, line: str, n: int) -> bool:
        """Fails: a long line without a terminal mark, symbol noise, or one that shouts after most words."""
        if len(self.symbol.findall(line)) > max(2, self.r.max_symbol_share * n):
            return False
        if n > self.r.long_line_words and not self.terminal.search(line):
            return False
        return not ("!!" in line or "??" in line or "?!" in line or "!?" in line) or \
            len(self.shout.findall(line)) <= max(1, self.r.max_shout_share * n)

    def navigation(self, line: str, n: int) -> bool:
        """Fails: breadcrumbs and menus, by separators or by vocabulary."""
        if self.seps and len(self.seps.findall(line)) > max(1, self.r.max_separator_share * n):
            return False
        return not (n <= 6 and all(w.strip(".,:;!").lower() in self.nav for w in line.split()))

    def boilerplate(self, line: str) -> bool:
        return self.boiler is None or not self.boiler.search(line.lower())

    def keeps(self, line: str) -> bool:
        n = len(line.split())
        return self.navigation(line, n) and self.boilerplate(line) and self.punctuation(line, n)


def _base(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """Counts per row from bytes; see the contract of op9 in queries.py."""
    out = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    for a, b in tb.chunks(offs):
        o = offs[a:b + 1] - offs[a]
        buf = data[offs[a]:offs[b]]
        n = b - a
        s, e, first = tb.word_spans(buf, o)
        row = np.repeat(np.arange(n), np.diff(first))
        out["n_words"].append(np.diff(first))
        per = lambda flag: np.diff(np.concatenate([[0], np.cumsum(flag)])[o])
        out["word_chars"].append(per(~tb.SPACE[buf] & ((buf & 0xC0) != 0x80)))
        out["n_symbols"].append(per(_SYMBOL[buf]))
        prefix = tb.prefix_hash(buf)
        salt = tb.mix(np.arange(1, n + 1, dtype=tb.U))
        # lines with a word: spans between line breaks and document ends
        cut = np.flatnonzero(buf == 10)
        ls = np.sort(np.concatenate([o[:-1], cut + 1]))
        le = np.sort(np.concatenate([cut, o[1:]]))
        doc = np.repeat(np.arange(n), 1 + np.diff(np.searchsorted(cut, o)))
        has = np.searchsorted(s, le) > np.searchsorted(s, ls)
        ls, le, doc = ls[has], le[has], doc[has]
        key = tb.span_hash(prefix, ls, le) ^ salt[doc]
        distinct = np.bincount(doc[np.unique(key, return_index=True)[1]], minlength=n)
        out["n_dup_lines"].append(np.bincount(doc, minlength=n) - distinct)
        # words inside a 3-word window that stands twice or more in its document
        cover = np.zeros(len(s), bool)
        if len(s) > 2:
            h = tb.span_hash(prefix, s, e)
            w = tb.combine([h[:-2], h[1:-1], h[2:]]) ^ salt[row[:-2]]
            inside = np.flatnonzero(row[:-2] == row[2:])
            w = w[inside]
            order = np.argsort(w)
            same = w[order][1:] == w[order][:-1]
            hit = np.zeros(len(w), bool)
            hit[order[1:][same]] = True
            hit[order[:-1][same]] = True
            hit = inside[hit]
            for k in range(3):
                cover[hit + k] = True
        out["n_repeat_words"].append(np.bincount(row[cover], minlength=n))
    return {k: (np.concatenate(v) if v else np.zeros(0)).astype(np.int64) for k, v in out.items()}


def _judge(texts: list, judge: LineJudge) -> tuple[np.ndarray, list]:
    """(share of word characters lost, cleaned text) per document."""
    lost, cleaned = np.zeros(len(texts)), []
    for i, t in enumerate(texts):
        if not t:
            cleaned.append(t)
            continue
        seen: dict[str, bool] = {}
        kept, all_chars, lost_chars = [], 0, 0
        for line in t.split("\n"):
            bare = line.strip(" \t\r\v\f")
            if not bare:
                kept.append(line)
                continue
            ok = seen.get(bare)
            if ok is None:
                ok = seen[bare] = judge.keeps(bare)
            size = len(bare) - bare.count(" ")
            all_chars += size
            if ok:
                kept.append(line)
            else:
                lost_chars += size
        lost[i] = lost_chars / max(1, all_chars)
        cleaned.append("\n".join(kept) if lost_chars else t)
    return lost, cleaned


def _mapper(cols: list[str], text: str, rules: LineRules, schema: pa.Schema):
    def run(batches):
        judge = LineJudge(rules)
        for batch in batches:
            col = batch.column(batch.schema.get_field_index(text))
            got = _base(*tb.binary(col))
            lost, cleaned = _judge(col.to_pylist(), judge)
            failed = (got["n_words"] < rules.min_words) | (100 * got["n_repeat_words"] > rules.max_repeat_pct * got["n_words"])
            more = got | {"base_failed": failed, "lost_share": lost, "kept": ~failed & (lost <= rules.max_lost_share),
                          "cleaned_text": cleaned}
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(cols))]
                + [pa.array(more[f.name], f.type) for f in list(schema)[len(cols):]], schema=schema)
    return run


MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "base_failed boolean, lost_share double, kept boolean")


def judge_documents(docs: DataFrame, text: str = "text", id_col: str = "doc_id", rules: LineRules = LineRules(),
                    with_text: bool = False) -> DataFrame:
    """One row per document: id, counts, verdict and (``with_text``) the cleaned text. No shuffle."""
    tune(docs.sparkSession)
    d = only(docs, **{"doc_id": id_col, "text": text})
    return _apply(d, "text", rules, with_text).drop("text")


def _apply(d: DataFrame, text: str, rules: LineRules, with_text: bool) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    more = StructType.fromDDL(MEASURES + (", cleaned_text string" if with_text else ""))
    schema = StructType(list(d.schema.fields) + list(more.fields))
    return d.mapInArrow(give_back(_mapper(d.columns, text, rules, to_arrow_schema(schema))), schema)


def clean_documents(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """Kept documents with their failing lines removed; the columns and types of the input.

    ``n_chars``, where the input has it as an integer, is set to the cleaned
    text's code points for texts that lost a line.
    """
    tune(docs.sparkSession)
    cols = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(cols))])
    t = f"c{cols.index('text')}"
    j = _apply(inner, t, rules, True).where("kept")
    changed = F.col("cleaned_text") != F.col(t)
    out = []
    for i, (c, f) in enumerate(zip(cols, docs.schema.fields, strict=True)):
        v = F.col(f"c{i}")
        if c == "text":
            v = F.col("cleaned_text")
        elif c == "n_chars" and f.dataType.simpleString() in ("int", "bigint"):
            v = F.when(changed, F.char_length("cleaned_text")).otherwise(v).cast(f.dataType)
        out.append(v.alias(c))
    return j.select(*out)
