"""Ids of the word cache equal those of the tokenizer."""

import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest

from uptake.llm.packing import Encoder, Known

ODD = ["", " ", "\n\t\r ", "don't WE'LL they're 's 't", "a\x1cb\x1fc\x0bd\x0ce\x85f\u00a0g\u2003h\u3000i", "\u0301x e\u0301 \u0301", "ΣΑΣ ΟΔΟΣ İI ß",
       "<|endoftext|> <|startoftext|>x", "12 345,67% #!? ...", "\U0001F600\U0001F468\u200d\U0001F469 \u0915\u094d\u0937 \uac00\u1100\u1161", "x" * 5000,
       "word," * 40 + " " + "é" * 70, "\x00\x01 \ufeffbom \ufffd", "a\u2028b\u2029c", "'" * 9 + "s", "İ i\u0307"]


@pytest.mark.parametrize("small", [False, True])
def test_ids_equal_encode(monkeypatch, small):
    if small:
        monkeypatch.setattr(Known, "ENTRIES", 5)
    encode = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert encode.by_words and encode.latin
    rng = random.Random(1)
    alphabet = [*"abcXYZ'sStT .,!?019\n\t", "é", "e\u0301", "\u0307", "Σ", "ſ", "\u212a", "ı", "İ", "\x85", "\x1e", "ﬁ", "\u0345", "あ", "½", "Ⅷ", "𝟘"]
    texts = [*ODD, *("".join(rng.choice("abE'sdD'll re'VE 019.,\n!éÀŸß") for _ in range(rng.randrange(60))) for _ in range(3000)), *("".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(3000))]
    if not small:
        texts += [t or "" for t in pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()]
    for text in texts:
        assert np.frombuffer(encode(text), encode.type).tolist() == encode.tok.encode(text, add_special_tokens=False).ids, text


def test_other_tokenizers_encode_whole_texts():
    encode = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not encode.by_words
    for text in ODD:
        assert np.frombuffer(encode(text), encode.type).tolist() == encode.tok.encode(text, add_special_tokens=False).ids
