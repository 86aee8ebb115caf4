"""What reused Python workers hold: the bound of the token cache, and freed memory."""

import re

import numpy as np

import corpus_pipeline
from tidemark.llm import packing
from tidemark.llm.common import give_back
from tidemark.llm.tokens import MOST, encoder


def held() -> int:
    """MB of this process without mapped files."""
    with open("/proc/self/smaps_rollup") as f:
        return sum(map(int, re.findall(r"Private_Dirty:\s+(\d+)", f.read()))) // 1024


def test_token_cache_is_bounded_and_ids_do_not_depend_on_it():
    texts = [" ".join(f"w{i}x{j}" for j in range(50)) for i in range(1200)]
    small, large = encoder("word_bpe_49k.json", 3000), encoder("word_bpe_49k.json")
    for a in range(0, len(texts), 100):
        got, want = small.encode(texts[a:a + 100]), large.encode(texts[a:a + 100])
        assert all(np.array_equal(x, y) for x, y in zip(got, want, strict=True))
        assert len(small.cache) <= 3000 + 100 * 50
    assert len(large.cache) >= 1200 * 50


def test_the_pipelines_packing_holds_less_than_packing_alone(monkeypatch):
    seen = []
    monkeypatch.setattr(packing, "pack_documents", lambda docs, p=packing.Packing(), **k: seen.append(p))
    corpus_pipeline.pack(None, None, "")
    assert seen[0].held < MOST == packing.Packing().held
    assert seen[0].tokens == packing.Packing().tokens


def test_freed_memory_goes_back_after_the_last_batch():
    def run(batches):
        for _ in batches:
            kept = [bytes(1000) for _ in range(200_000)]  # small blocks that the allocator keeps, below one that stays
            stay.append(bytes(1000))
            yield len(kept)
    stay: list[bytes] = []
    list(run(iter([1])))
    before = held()
    out = list(give_back(run)(iter([1, 2])))
    assert out == [200_000, 200_000] and held() < before - 100
