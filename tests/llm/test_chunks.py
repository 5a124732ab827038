"""How texts are cut before they are encoded, and how new words are learned."""

import random
import re

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from kontor.llm import bpe, packing


def test_plain_texts_are_cut_without_a_pattern(monkeypatch):
    class Unused:
        def split(self, text):
            raise AssertionError(text)

    monkeypatch.setattr(bpe, "_CUT", Unused())
    assert bpe.chunks_of("one two,\nthree  ".rstrip()) == ["one", " two,\nthree"]
    assert bpe.chunks_of(" one é") == [" one", " é"] and bpe.chunks_of("") == []


def test_chunks_are_those_of_the_pattern():
    random.seed(1)
    for _ in range(20_000):
        text = "".join(random.choice(" a,\n\t \x1c\0é\xa0") for _ in range(random.randint(0, 7)))
        plain = re.split(r"(?= \S)", text)
        assert bpe.chunks_of(text) == (plain if plain[0] else plain[1:])


def test_new_words_have_the_ids_of_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        words = packing._Words(file.read(), False, 1 << 20)
    random.seed(2)
    pick = lambda: "".join(random.choice("abéß日.,;!\n 1") for _ in range(random.randint(1, 9)))
    for _ in range(40):
        text = " ".join(pick() for _ in range(30))
        chunks = words.chunks(text)
        words.learn(set(chunks))
        ids = np.frombuffer(b"".join(words.ids[c] for c in chunks), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids


def test_texts_of_a_block_have_the_ids_of_the_library():
    """Words are learned without the marks around them; texts, also empty ones, never meet."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        words = packing._Words(file.read(), False, 1 << 20)
    learned = set(words.chunks("one (two) two, two.\none$ 12: two"))
    assert learned == {b"one", b" (", b" two", b"two", b")", b",", b".", b"\n", b"$", b" 12", b":"}
    letters = "abst19é×÷日٣ .,!'-_(\n\t\x1c\0\x85\xa0 ᠎ —“　﻿😀"
    random.seed(3)
    for trial in range(200):
        some = letters if trial % 2 else "ab's.,- \n "
        texts = ["".join(random.choices(some, k=random.randint(0, 30))) for _ in range(40)]
        texts += ["", "<|endoftext|>", "a  <|endoftext|> \n", " <|endoftext|", ">"]
        raw = [text.encode() for text in texts]
        offsets = np.append(0, np.cumsum(list(map(len, raw))))
        found = words.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
        for text, ids in zip(texts, found, strict=True):
            expected = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == expected
