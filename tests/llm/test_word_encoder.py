from __future__ import annotations

import random

import public_tokenizers
import pyarrow as pa
import pytest

from lorekiln.llm.word_encoder import WordEncoder

ODD = [
    "", " ", "\n", "a  b", "  x ", "a\n\nb", "a \n b", "tab\tx  y\t", "x y z", "\x00 a", "don't I'll 12 345,!? ..", "a  b", "é à\r\nq", "end\n", "a   b    c\n\n\n d",
    "　x", "J̌ H̱", "é.", "a.b,c", "a .b", "3.14,15", "<|endoftext|> x", "İI ſ", "word..,word", None,
]


@pytest.mark.parametrize(("name", "spaced"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_ids_are_the_library_s(name, spaced):
    encoder = WordEncoder(public_tokenizers.path(name), spaced)
    rng = random.Random(2)
    pieces = [t for t in ODD if t] + ["Hello", "world", ",", ".", " ", "\n", "ß", "日本", "😀", "́", "1", "'s", "-", "\t"]
    texts = ODD + ["".join(rng.choices(pieces, k=rng.randrange(1, 9))) for _ in range(1500)] + [" ".join(rng.choices(["Foo", "bar,", "baz."], k=50))] * 2
    for text, ids in zip(texts, encoder.encode(pa.array(texts, pa.string())), strict=True):
        assert ids.tolist() == encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, repr(text)
