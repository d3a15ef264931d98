"""Word cache against the whole library: every letter before and between signs."""

import sys

import numpy as np
import pytest

from verso.llm import repair_ids as P
from verso.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def cache():
    return P.WordCache(tokenizer_path("word_bpe_49k.json"))


def same(cache, texts):
    want = cache.whole.encode_batch(texts, add_special_tokens=False)
    return [t for t, w in zip(texts, want) if np.frombuffer(cache.encode(t), dtype="<u4").tolist() != w.ids]


def test_direct_path_is_taken(cache):
    assert cache.direct


def test_letters_whose_lower_case_is_longer(cache):
    long = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and len(chr(c).lower()) > 1]
    assert "\u0130" in long
    assert same(cache, [f"{a}{c}{b}" for c in long for a in ("", "x", "X.") for b in ("", ".", "...", "%!", "x", ". y", "\n")]) == []


def test_every_code_point_before_signs(cache):
    points = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for form in ("a{}.", "{}!", "B{}, c{}"):
        texts = [form.format(c, c) for c in points]
        for lo in range(0, len(texts), 20_000):
            assert same(cache, texts[lo : lo + 20_000]) == []
            cache.clear()
