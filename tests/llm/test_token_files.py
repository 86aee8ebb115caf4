import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import simple8b, token_files as tf
from tidemark.llm.tokens import Encoder, encoder


@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_256), st.integers(0, 2**64 - 1)), max_size=1500))
@settings(max_examples=60, deadline=None)
def test_round_trip(x):
    ids = np.array(x, np.uint64)
    words, blocks = simple8b.encode(ids)
    assert (simple8b.decode(words, blocks, len(ids)) == ids).all() and blocks[-1] == len(words)


def test_any_block_decodes_alone():
    ids = np.random.default_rng(1).integers(0, 50_000, 5_000).astype(np.uint64)
    words, blocks = simple8b.encode(ids)
    b = simple8b.BLOCK
    for k in (0, 3, 11):
        part = simple8b.decode(words[blocks[k]:blocks[k + 1]], blocks[k:k + 2] - blocks[k], b)
        assert (part == ids[k * b:(k + 1) * b]).all()
    assert len(words) * 64 < 21 * len(ids)


def test_broken_files_raise():
    data = tf.to_bytes([1, None], [np.arange(5, dtype=np.uint64), np.zeros(0, np.uint64)])
    docs, start, ids = tf.from_bytes(data)
    assert docs == [1, None] and start.tolist() == [0, 5, 5] and ids.tolist() == [0, 1, 2, 3, 4]
    for bad in (b"x" + data[1:], data + b"x", data[:-3]):
        with pytest.raises(ValueError):
            tf.from_bytes(bad)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@given(t=st.text(st.one_of(st.sampled_from(" \n\t\x1c\x85\xa0aA0é.'s"), st.characters(codec="utf-8")), max_size=40))
@settings(max_examples=150, deadline=None)
def test_parts_equal_whole_texts(name, t):
    e = encoder(name)
    assert e.encode([t])[0].tolist() == e.t.encode(t, add_special_tokens=False).ids


def test_files_hold_all_documents(docs, rows):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    folder, m = tf.write(docs, tf.TokenFiles(file_ids=5_000))
    got = {r.doc_id: r for r in tf.read(folder, m, with_ids=True).collect()}
    at = 0
    assert m.count() > 3 and len(got) == len(rows)
    for i, t in sorted(rows):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        r = got[i]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), brute.crc(ids))
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        at += len(ids)


def test_odd_tables(none, repeated):
    assert tf.read(*tf.write(none)).count() == 0
    got = sorted(tf.read(*tf.write(repeated)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [1, 1, 1, 2, None, None]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:], strict=False))


@given(st.lists(st.integers(0, 2**16 - 1), max_size=1500))
@settings(max_examples=40, deadline=None)
def test_narrow_ids_are_coded_as_wide_ones(x):
    for a, b in zip(simple8b.encode(np.array(x, np.uint64)), simple8b.encode(np.array(x, np.uint16)), strict=True):
        assert (a == b).all()


def test_plain_words_go_straight_to_the_merges():
    """Words of letters, behind a line break or before signs, get the library's ids without its pattern; others still meet it."""
    class NoPattern:
        def __init__(self, t):
            self.model, self.token_to_id = t.model, t.token_to_id

        def encode_batch_fast(self, texts, **_):
            assert not texts
            return []
    e = Encoder("byte_bpe_50k.json")
    whole = e.t
    words = ["word", "Wörter", "été", "\nLine", "\nEnd.", "end,", "sum$$$", "HEAD!!", "中文", "x", "y;", *[f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]]
    e.t = NoPattern(whole)
    e._learn(words)
    got = {w: np.frombuffer(e.cache[w], e.dtype).tolist() for w in words}
    e.t = whole
    assert got == {w: e.t.encode(e._text(w), add_special_tokens=False).ids for w in words}
    odd = ["it's", "don't,", "\nl'été", "a1", "x-y", "naïve!", "\nétude", "42", "ª", "a\u0301b", "<|endoftext|>", "ſo", "Ǆa"]
    e._learn(odd)
    assert {w: np.frombuffer(e.cache[w], e.dtype).tolist() for w in odd} == {w: e.t.encode(e._text(w), add_special_tokens=False).ids for w in odd}


def test_a_tokenizer_with_words_as_added_tokens_keeps_the_long_way(tmp_path):
    e = Encoder("byte_bpe_50k.json")
    e.t.add_tokens(["word"])
    e.t.save(str(tmp_path / "t.json"))
    f = Encoder(str(tmp_path / "t.json"))
    assert e.bound and not f.bound
    assert f.encode(["some word here"])[0].tolist() == f.t.encode("some word here", add_special_tokens=False).ids
