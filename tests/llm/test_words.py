"""Encoding word by word gives the ids of whole texts."""

import random

import numpy as np
import public_tokenizers as tokens
import pytest

from seatwise.llm import token_index

PATH = tokens.path("word_bpe_49k.json")
PARTS = ["ALİ", "İ", "ali", "Straße", "ÉCOLE", "Σίσυφος", "Ω", "ß", "ǅ", "ﬁn", "日本", "word", "İ", "é",
         "̇", "́", ".", ",", "!", "?", "'s", "'", "-", "12", "3.5", "#", "()", "a", "B", "Ａ", "ñ"]
SPACES = ["", "", " ", " ", "  ", "\n", "\t", " ", " ", "\x85"]


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(seed):
    from tokenizers import Tokenizer

    rng = random.Random(seed)
    width, plain = token_index.id_width(PATH), Tokenizer.from_file(PATH)
    found_by = token_index.WordIds(PATH, width)
    texts = ["".join(rng.choice(PARTS) + rng.choice(SPACES) for _ in range(rng.randint(1, 12)))
             for _ in range(5_000)] + ["ALİ. geldi", "İ!", "VELİ, x"]
    for start in range(0, len(texts), 250):
        part = texts[start:start + 250]
        for text, found in zip(part, found_by.encode(part), strict=True):
            wanted = plain.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(found, width).tolist() == wanted, repr(text)
