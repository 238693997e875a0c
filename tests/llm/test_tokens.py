"""Ids of words against the tokenizer on whole texts, and how many texts it is given."""

import random

import numpy as np

from kindred.llm import tokens


class Counted:
    """A tokenizer that counts the texts it encodes."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def encoded(texts):
    encoder = tokens.WordEncoder(tokens.default_vocabulary())
    whole = [e.ids + [tokens.END_ID] for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    encoder.tokenizer = counted = Counted(encoder.tokenizer)
    found = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode([t.encode() for t in texts])]
    return found, whole, counted.texts


def test_words_of_letters_are_encoded_many_to_a_text():
    rng = random.Random(3)
    words = sorted({"".join(rng.choices("abcdeéßñ", k=9)) for _ in range(3000)})
    found, whole, texts = encoded([" ".join(w + rng.choice(["", ",", "&&&", "$$$"]) for w in words)])
    assert found == whole
    assert texts < 20


def test_odd_words_have_the_ids_of_whole_texts():
    rng = random.Random(5)
    signs = "abzÀéßſİı'’s.t,!<|>&$#0١９Ⅷ५ªºक़中̸̧́\u0085 ‍-_ ẞΣςʰ×÷="
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(2000)]
    found, whole, _ = encoded(texts + ["<|endoftext|>, A<|x it's, b'", "ÀB×, İ, é&&& ñ$$$"])
    assert found == whole
