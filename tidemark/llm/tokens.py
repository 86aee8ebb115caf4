"""Token ids from the public tokenizer files, word by word.

Both vocabularies split a text at single spaces between other characters
before any merge, so the ids of a text are the ids of its parts in order.
Parts are encoded by the tokenizers library once per worker and kept; texts
are put together from them.  The cache lives as long as the Python worker and
is emptied when it holds ``most`` parts.
"""

from __future__ import annotations

import json
import operator
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MOST = 1_300_000
#: what str.split() takes for white space and Unicode does not
_SEPARATORS = re.compile("[\x1c-\x1f]")
#: white space at an end or beside white space: such a text can't be cut at every space and line break
_ODD = re.compile(r"\s(?:\s|\Z)")
#: ASCII letters, maybe behind a line break or before signs: the byte-level pattern keeps the three apart (but for an apostrophe)
_ASCII = re.compile(r"\n?[A-Za-z]+[!-&(-/:-@\[-`{-~]*").fullmatch
#: letters alone are one unit
_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u4e00-\u9fa5]+").fullmatch
#: byte-level characters of the bytes that do not stand for themselves
_BYTES = {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if not (33 <= x <= 126 or 161 <= x <= 172 or x >= 174))}
_TOKEN = operator.attrgetter("id")
_OPEN: dict[tuple, "Encoder"] = {}


def encoder(name: str, most: int = MOST) -> "Encoder":
    """The worker's encoder for a file of the public tokenizers (or a path), whose cache is emptied at ``most`` parts."""
    if (name, most) not in _OPEN:
        _OPEN[name, most] = Encoder(name, most)
    return _OPEN[name, most]


class Encoder:
    def __init__(self, name: str, most: int = MOST):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        from tokenizers import Tokenizer
        path = name
        if not os.path.isabs(name):
            import public_tokenizers
            path = public_tokenizers.path(name)
        self.t = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.t.get_vocab_size() <= 1 << 16 else "<u4")
        self.cache: dict[str, bytes] = {}
        self.most = most
        # a part may start with its space (byte-level), or spaces count for nothing (word ends)
        self.glue = " " if self._ids("a b") != self._ids("a") + self._ids("b") else ""
        # a separator that stays a token of its own: a line break before a space, or a digit among words
        self.sep = "\n" if self.glue else " 0 "
        self.sep_id = self._ids(self.sep)[0]
        self.bound = self._boundary()

    def _boundary(self) -> str:
        """A byte's character that no merge contains, so that words between such characters are merged each by itself.

        Empty where units other than the byte-level pattern's may arise (another normalizer, pre-tokenizer or model,
        an added token that a word could hold), or where a merge joins letters to signs or line breaks.
        """
        if not self.glue:
            return ""
        j = json.loads(self.t.to_str())
        pre, model = j["pre_tokenizer"] or {}, j["model"]
        if (any(j[k] for k in ("normalizer", "post_processor", "truncation", "padding")) or model["type"] != "BPE"
                or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
                or pre.get("type") != "ByteLevel" or not pre.get("use_regex") or pre.get("add_prefix_space")
                or any(_ASCII(x["content"].strip()) or _LETTERS(x["content"].strip()) or not x["content"].isascii() or re.fullmatch(r"[^A-Za-z]*", x["content"])
                       for x in j["added_tokens"]) or len(self._ids("\n")) != 1):
            return ""
        long = [x for x in model["vocab"] if len(x) > 1]
        if any(re.search("[A-Za-z]", x) and re.search(r"[!-&(-/:-@\[-`{-~\u010a]", x) for x in long):
            return ""
        merged = set().union(*long)
        # bytes that no UTF-8 text holds
        return next((chr(x) for x in range(0xF5, 0x100) if chr(x) in model["vocab"] and chr(x) not in merged), "")

    def _ids(self, text: str) -> list[int]:
        return self.t.encode(text, add_special_tokens=False).ids

    def parts(self, text: str) -> list[str]:
        """Keys of the text's parts, in order.

        Byte-level: cut before each single space or line break between two
        characters that are no white space; a key that begins with a line
        break holds it, any other but the first stands behind a space.  Word
        ends: the runs between white space.
        """
        if not self.glue and not _SEPARATORS.search(text):
            return text.split()
        p = text.replace("\n", " \n").split(" ") if self.glue else text.split(" ")
        if "" not in p and "\n" not in p and not any(x[0].isspace() or x[-1].isspace() for x in p if not (x.isalnum() or x[0] == "\n")) \
                and not any(x[1].isspace() or x[-1].isspace() for x in p if x[0] == "\n"):
            return p
        p = text.split(" ")
        out = [p[0]]
        for x in p[1:]:
            last = out[-1]
            if x and last and not x[0].isspace() and not last[-1].isspace():
                out.append(x)
            else:
                out[-1] = last + " " + x
        return out

    def _text(self, key: str) -> str:
        return key if key[:1] == "\n" and self.glue else self.glue + key

    def _learn_words(self, words: list[str], ascii_: bool) -> None:
        """Words straight through the library's merges, many at once."""
        w, at = self.dtype.itemsize, self.t.token_to_id(self.bound)
        for i in range(0, len(words), 128):
            some = words[i:i + 128]
            if ascii_:
                text = ("\u0120" + f"{self.bound}\u0120".join(some)).replace("\u0120\n", "\u010a")
            else:
                text = self.bound.join([(" " + x).encode().decode("latin-1").translate(_BYTES) for x in some])
            ids = np.fromiter(map(_TOKEN, self.t.model.tokenize(text)), self.dtype)
            cut, raw = np.flatnonzero(ids == at) * w, ids.tobytes()
            bounds = map(slice, [0, *(cut + w).tolist()], [*cut.tolist(), len(raw)])
            self.cache.update(zip(some, map(raw.__getitem__, bounds), strict=True))

    def _learn(self, new: list[str]) -> None:
        """Many parts in one text, between separators that are tokens of their own; odd parts one by one."""
        if self.bound:
            plain, words, rest = [], [], []
            for x in new:
                (plain if _ASCII(x) else words if _LETTERS(x) else rest).append(x)
            self._learn_words(plain, True)
            self._learn_words(words, False)
            new = rest
        sep = self.sep.strip(" ")
        plain = [x for x in new if sep not in x]
        breaks = [x for x in new if sep in x and self.glue and x[0] == sep and x.count(sep) == 1]
        odd = [x for x in new if sep in x and not (self.glue and x[0] == sep and x.count(sep) == 1)]
        for keys, lead in ((plain, 0), (breaks, 1)):
            runs = [keys[i:i + 512] for i in range(0, len(keys), 512)]
            texts = ["".join(r) if lead else self.sep.join(self.glue + x for x in r) for r in runs]
            for some, e in zip(runs, self.t.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                ids = np.array(e.ids, self.dtype)
                cut = np.flatnonzero(ids == self.sep_id)
                if len(cut) != len(some) - 1 + lead:  # a part holds the separator's id: no bounds to trust
                    odd += some
                    continue
                raw, w = ids.tobytes(), self.dtype.itemsize
                lo = (cut * w).tolist() if lead else [0, *((cut + 1) * w).tolist()]
                hi = [*(cut[lead:] * w).tolist(), len(raw)]
                self.cache.update(zip(some, map(raw.__getitem__, map(slice, lo, hi)), strict=True))
        for i in range(0, len(odd), 4096):
            some = odd[i:i + 4096]
            for part, e in zip(some, self.t.encode_batch_fast([self._text(x) for x in some], add_special_tokens=False), strict=True):
                self.cache[part] = np.array(e.ids, self.dtype).tobytes()

    def _known(self, keys: list[str]) -> list[bytes]:
        """Ids of distinct parts, as bytes."""
        if len(self.cache) > self.most:
            self.cache.clear()
        got = list(map(self.cache.get, keys))
        if None in got:
            self._learn([x for x, y in zip(keys, got, strict=True) if y is None])
            get = self.cache.__getitem__
            got = [get(x) if y is None else y for x, y in zip(keys, got, strict=True)]
        return got

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        """Byte-level ids of texts without odd white space: split and counted by Arrow, so only distinct parts are looked up."""
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n"), " ")
        word, ends = split.flatten().dictionary_encode(), np.asarray(split.offsets)
        got = self._known(word.dictionary.to_numpy(zero_copy_only=False).tolist())  # as to_pylist(), in a tenth of its time
        _, bound, ids = pa.array(got, pa.large_binary()).take(word.indices).buffers()
        bound, ids = np.frombuffer(bound, np.int64) // self.dtype.itemsize, np.frombuffer(ids, self.dtype)
        # a text's first part stands behind no space
        heads = [np.array(self._ids(x), self.dtype) for x in split.flatten().take(pa.array(ends[:-1])).to_pylist()]
        return [np.concatenate([h, ids[a:b]]) for h, a, b in zip(heads, bound[ends[:-1] + 1], bound[ends[1:]], strict=True)]

    def encode(self, texts: list) -> list[np.ndarray]:
        """Ids of each text (null: none)."""
        if not self.glue:
            return self._encode(texts)
        plain = [i for i, t in enumerate(texts) if t and not t[0].isspace() and not _ODD.search(t)]
        rest = sorted(set(range(len(texts))) - set(plain))
        out: list = [None] * len(texts)
        for at, ids in ((plain, self._plain([texts[i] for i in plain]) if plain else []), (rest, self._encode([texts[i] for i in rest]))):
            for i, x in zip(at, ids, strict=True):
                out[i] = x
        return out

    def _encode(self, texts: list) -> list[np.ndarray]:
        out = []
        for a in range(0, len(texts), 256):
            split = [self.parts(t) if t else [] for t in texts[a:a + 256]]
            if len(self.cache) > self.most:
                self.cache.clear()
            heads = [self._ids(p[0]) if p else [] for p in split] if self.glue else None
            flat = [x for p in split for x in (p[1:] if self.glue else p)]
            got = list(map(self.cache.get, flat))
            if None in got:
                self._learn(list({x for x, y in zip(flat, got, strict=True) if y is None}))
                get = self.cache.__getitem__
                got = [get(x) if y is None else y for x, y in zip(flat, got, strict=True)]
            at = 0
            for i, p in enumerate(split):
                n = max(0, len(p) - 1) if self.glue else len(p)
                body = b"".join(got[at:at + n])
                at += n
                if self.glue:
                    body = np.array(heads[i], self.dtype).tobytes() + body
                out.append(np.frombuffer(body, self.dtype))
        return out
