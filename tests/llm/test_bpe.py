from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from requestmill.llm import bpe

from .conftest import TEXTS

PATH = public_tokenizers.path("word_bpe_49k.json")
SPEC = open(PATH, encoding="utf-8").read()


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def expected(reference, text):
    ids = reference.encode(text or "", add_special_tokens=False).ids
    return " ".join(map(str, ids)), reference.decode(ids, skip_special_tokens=False), len(ids)


def odd_texts():
    rng = random.Random(4)
    signs = "ab Zé\n\t  ́İßΣς '’s12３#<|endoftext|>\r\x0b日本🙂"
    return [*TEXTS, "x<|endoftext|>y <|startoftext|>", "é ́e", "ΑΣ ΣΑ"] + [
        "".join(rng.choice(signs) for _ in range(rng.randint(1, 4_000))) for _ in range(40)
    ]


def test_same_as_the_library(reference):
    encoder = bpe.Encoder(SPEC)
    for text in odd_texts():
        assert encoder.encode((text or "").encode()) == expected(reference, text)


def test_given_documents(reference, documents, texts):
    rows = bpe.encode(documents, PATH).collect()
    got = {r["doc_id"]: (r["ids"], r["decoded"], r["n_tokens"]) for r in rows}
    assert got == {i: expected(reference, t) for i, t in texts.items()}


def test_every_cut_is_repaired(reference, monkeypatch):
    """Cuts every few bytes, most of them inside words."""
    monkeypatch.setattr(bpe.cut_points, "__defaults__", (2, None))
    encoder = bpe.Encoder(SPEC)
    for text in odd_texts()[:30]:
        text = (text or "")[:3_000]
        assert encoder.encode(text.encode()) == expected(reference, text)
    assert encoder.encoded_chunks > 1_000


def test_shared_passages_are_encoded_once():
    rng = random.Random(9)
    shared = " ".join(f"word{rng.randint(0, 10_000)}" for _ in range(4_000)).encode()
    encoder = bpe.Encoder(SPEC)
    encoder.encode(b"first text: " + shared)
    before = encoder.encoded_chunks
    encoder.encode(b"a second one that starts otherwise " + shared)
    assert encoder.encoded_chunks - before <= 3 and encoder.reused_chunks >= before - 3


def test_only_new_chunks_are_split_into_words(monkeypatch):
    """The words of a passage that is known are not looked at again."""
    rng = random.Random(11)
    shared = " ".join(f"word{rng.randint(0, 10_000)}" for _ in range(4_000)).encode()
    encoder = bpe.Encoder(SPEC)
    whole = encoder.encode(b"first text: " + shared)
    asked = []
    real = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda words: asked.extend(words) or real(words))
    again = encoder.encode(b"first text: " + shared)
    assert again == whole and len(asked) < 200


class Joining(bpe.Encoder):
    """A tokenizer that takes two pairs of words for one token each: blanks do not always cut."""

    TOKENS = {"ice cream": 1, "new york": 2}

    def _ids(self, text):
        words, ids, k = text.decode().split(), [], 0
        while k < len(words):
            for said, token in self.TOKENS.items():
                size = len(said.split())
                if " ".join(words[k : k + size]) == said:
                    ids.append(token)
                    k += size
                    break
            else:
                ids.append(10 + sum(words[k].encode()))
                k += 1
        return ids

    def _learn(self, words):
        for w in words:
            self.words[w] = self._encoded(self._ids(w))

    def _encoded(self, ids):
        return " ".join(map(str, ids)), "", len(ids)


def test_joins_are_widened_until_they_agree(monkeypatch):
    """Cuts at each blank; chunks hold no inner words, so every joined token lies over joins."""
    monkeypatch.setattr(bpe, "cut_points", lambda data, **_: [*(k + 1 for k in range(len(data)) if data[k] == 32), len(data)])
    for text in ("we eat ice cream now", "ice cream", "in new york", "new york ice cream new york", "ice ice cream cream", "no joined one"):
        encoder = Joining(SPEC)
        assert encoder.encode(text.encode())[0] == " ".join(map(str, encoder._ids(text.encode())))
        assert (encoder.widened_joins > 0) == ("no" not in text.split()[0])


def test_cuts_follow_the_content():
    rng = random.Random(1)
    data = "".join(rng.choice("abcdefgh ") for k in range(40_000)).encode()
    cuts = bpe.cut_points(data)
    moved = bpe.cut_points(b"some bytes in front" + data)
    assert cuts[-1] == len(data) and len(cuts) > 10
    assert {c - 19 for c in moved if c > 100} >= {c for c in cuts if c > 100}
    euro = ("€" * 5_000).encode()
    assert all(c == len(euro) or euro[c] & 0xC0 != 0x80 for c in bpe.cut_points(euro, bits=1))


def test_memory_is_bounded(reference, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_KEPT", 50)
    monkeypatch.setattr(bpe, "CHUNKS_KEPT", 4)
    encoder = bpe.Encoder(SPEC)
    for k in range(30):
        text = " ".join(f"w{k * j % 401}" for j in range(900))
        assert encoder.encode(text.encode()) == expected(reference, text)
    assert len(encoder.chunks) <= 4


def test_other_tokenizers_are_refused():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        spec = file.read()
    with pytest.raises(ValueError, match="white space"):
        bpe.Encoder(spec)


def test_odd_rows(reference, odd_docs, odd_rows, no_docs):
    rows = bpe.encode(odd_docs, PATH).collect()
    want = sorted(expected(reference, t) for _, t, *_ in odd_rows)
    assert sorted((r["ids"], r["decoded"], r["n_tokens"]) for r in rows) == want
    assert bpe.encode(no_docs, PATH).count() == 0
