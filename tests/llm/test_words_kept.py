"""What a worker keeps of the words it has met."""

import pytest

from weftline.llm import packing

tokenizers = pytest.importorskip("public_tokenizers")


def test_words_are_gone_with_the_task():
    path = tokenizers.path("word_bpe_49k.json")
    encode = packing._encoder(path)
    texts = [f"word{i} other{i * 7919}" for i in range(500)]
    first = list(encode(texts))
    assert list(packing._encoder(path)(texts)) == first
    kept = packing._tokenizers[path]
    assert not any(isinstance(x, (dict, list)) for x in kept)
