"""BPE encoding with reuse of content-defined chunks.

A rolling hash over the bytes cuts texts where their content says so, so passages that documents
share give the same chunks wherever they stand. A chunk is encoded once in a worker and then
looked up: words are split and encoded for new chunks only. A cut may fall inside a word, so each join is
repaired: the word around it is encoded anew, and a stretch of it and its neighbours is encoded by the
tokenizer as one text. If that does not agree with the parts, the stretch is widened until its ends agree
with the words that stand there, and takes the place of what was joined.

For tokenizers that drop white space and cut there; others are refused. With these the first stretch
always agrees, but it is compared all the same.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from requestmill.llm.common import worker_state

CUT_BITS = 10  # chunks of about 1 KB
WINDOW = 32  # bytes that decide about a cut
WORDS_KEPT = 150_000
PARTS_KEPT = 250_000
# Letters that neither composition nor lower case turns into anything but one letter, and ASCII
# signs but the apostrophe behind them.
LETTERS = re.compile(
    "([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\\[-`{-~]*)"
)
CHUNKS_KEPT = 4_000
BLANK = b" "


Encoded = tuple[str, str, int]


def _concatenated(found: list[Encoded]) -> Encoded:
    """Encodings one after the other; those without ids leave no blank."""
    if not found:
        return "", "", 0
    ids, texts, counts = zip(*found, strict=True)
    if 0 in counts:
        return _concatenated([f for f in found if f[2]])
    return " ".join(ids), " ".join(texts), sum(counts)


def _byte_letters(text: str) -> str:
    """Letters up to U+00FF as byte-level vocabularies spell them: a letter for each UTF-8 byte.
    Bytes that are no printable Latin-1 character have the letters from U+0100 on, in order."""
    if text.isascii():
        return text
    return "".join(map(_BYTE_LETTER.__getitem__, text.encode()))


_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTER = {b: chr(b) for b in _PRINTABLE} | {
    b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in _PRINTABLE)
}


def _gear() -> np.ndarray:
    return np.random.default_rng(20_240_229).integers(0, 1 << 32, 256, dtype=np.uint32)


def cut_points(data: bytes, bits: int = CUT_BITS, gear: np.ndarray | None = None) -> list[int]:
    """Ends of all chunks, the last one's included. They lie between characters."""
    codes = np.frombuffer(data, np.uint8)
    hashed = (_gear() if gear is None else gear)[codes]
    width = 1
    while width < WINDOW:  # sums of the last 2, 4, 8, ... bytes, shifted by their distance
        older = np.zeros_like(hashed)
        older[width:] = hashed[:-width] << np.uint32(width)
        hashed = hashed + older
        width *= 2
    ends = np.flatnonzero((hashed >> np.uint32(32 - bits)) == 0) + 1
    found = []
    for end in ends.tolist():
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        if end < len(data) and (not found or end > found[-1]):
            found.append(end)
    return [*found, len(data)]


def _word_bound(spec: dict) -> bool:
    """Whether the tokenizer puts texts in lower case, cuts them at white space, drops that, and
    adds nothing around them."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    split = next((s for s in steps if s["type"] == "Split"), None)
    rest = [s for s in steps if s is not split]
    first = (spec.get("normalizer") or {}).get("normalizers", [])
    plain = all(
        not (t["lstrip"] or t["rstrip"] or t["single_word"]) and not set(t["content"]) & set(" \n")
        for t in spec.get("added_tokens", [])
    )
    return bool(
        split
        and split["behavior"] == "Removed"
        and split["invert"]
        and "\\s" in split["pattern"].get("Regex", "")
        and [s["type"] for s in first] == ["NFC", "Replace", "Lowercase"]
        and [s["type"] for s in rest] == ["ByteLevel"]
        and not (rest[0]["add_prefix_space"] or rest[0]["use_regex"])
        and spec.get("decoder") is None
        and plain
    )


class Encoder:
    """Encodes texts; keeps words and chunks that it has seen, up to a fixed number."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
        from tokenizers import Tokenizer

        if not _word_bound(json.loads(spec)):
            raise ValueError("the tokenizer must drop white space and cut there")
        self.tokenizer = Tokenizer.from_str(spec)
        # for words of plain letters, which its first steps only put in lower case
        bare = {"normalizer": None, "pre_tokenizer": None, "added_tokens": []}
        self.bare = Tokenizer.from_str(json.dumps(json.loads(spec) | bare))
        for tokenizer in (self.tokenizer, self.bare):
            tokenizer.no_truncation()
            tokenizer.no_padding()
        self.gear = _gear()
        self.words: dict[bytes, Encoded] = {}
        self.parts: dict[str, Encoded] = {}
        self.chunks: dict[bytes, tuple] = {}
        self.encoded_chunks = self.reused_chunks = self.widened_joins = 0

    def chunks_of(self, text: bytes) -> list[tuple[bytes, bytes]]:
        """(digest, bytes) of each chunk."""
        found, start = [], 0
        for end in cut_points(text, gear=self.gear):
            chunk = text[start:end]
            found.append((xxhash.xxh3_128_digest(chunk), chunk))
            start = end
        return found

    def prepare(self, texts: list[bytes]) -> list[list[tuple[bytes, bytes]]]:
        """The chunks of several texts. Words of new chunks, and words that cuts divide, are encoded at once."""
        plans = list(map(self.chunks_of, texts))
        words: set[bytes] = set()
        new: set[bytes] = set()
        for text, plan in zip(texts, plans, strict=True):
            flat = text.replace(b"\n", BLANK)
            at = 0
            for key, chunk in plan:
                if key not in self.chunks and key not in new:
                    new.add(key)
                    words.update(chunk.replace(b"\n", BLANK).split(BLANK)[1:-1])
                at += len(chunk)
                if len(plan) > 1 and at < len(flat):
                    words.add(_word_at(flat, at))
            if plan:
                words.add(_word_at(flat, 0))
                words.add(_word_at(flat, len(flat)))
        self._learn(words)
        return plans

    def _learn(self, words: Iterable[bytes]) -> None:
        """Encode words that are not known.

        A word of plain letters, perhaps with signs behind it, is looked up as its letters in
        lower case and its signs: the tokenizer cuts there anyway.
        """
        missing = {w for w in words if w not in self.words}
        if len(self.words) + len(missing) > WORDS_KEPT:
            self.words.clear()
            missing = set(words)
        if len(self.parts) > PARTS_KEPT:
            self.parts.clear()
        split: dict[bytes, tuple[str, ...]] = {}
        plain: set[str] = set()
        other: set[str] = set()
        for word in missing:
            text = word.decode()
            if (m := LETTERS.fullmatch(text)) is None:
                split[word] = (text,)
                other.add(text)
                continue
            stem, signs = m[1].lower(), m[2]
            plain.add(stem)
            if signs:
                split[word] = (stem, signs)
                other.add(signs)
            else:
                split[word] = (stem,)
        known = self.parts
        self._encode_parts([p for p in plain if p not in known], self.bare, _byte_letters)
        self._encode_parts([p for p in other if p not in known], self.tokenizer, str)
        for word, parts in split.items():
            if len(parts) == 1:
                self.words[word] = known[parts[0]]
            else:
                a, b = known[parts[0]], known[parts[1]]
                self.words[word] = (f"{a[0]} {b[0]}", f"{a[1]} {b[1]}", a[2] + b[2])

    def _encode_parts(self, parts: list[str], tokenizer, spelled: Callable[[str], str]) -> None:
        if not parts:
            return
        found = tokenizer.encode_batch_fast(list(map(spelled, parts)), add_special_tokens=False)
        ids = [e.ids for e in found]
        texts = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        for part, i, text in zip(parts, ids, texts, strict=True):
            self.parts[part] = (" ".join(map(str, i)), text, len(i))

    def _joined(self, words: list[bytes]) -> Encoded:
        """(ids, decoded text, number of ids) of whole words."""
        found = list(map(self.words.get, words))
        if None in found:
            self._learn(words)
            found = [self.words[w] for w in words]
        return _concatenated(found)

    def _chunk(self, key: bytes, chunk: bytes) -> tuple:
        """(bytes up to the first blank, encoding of the words between, bytes behind the last)
        and the words next to the ends; a chunk without a blank is all first bytes."""
        if (known := self.chunks.get(key)) is not None:
            self.reused_chunks += 1
            return known
        self.encoded_chunks += 1
        words = chunk.replace(b"\n", BLANK).split(BLANK)
        if len(words) == 1:
            made = (words[0], None, None, b"", b"")
        else:
            inner = [w for w in words[1:-1] if w]
            made = (
                words[0],
                self._joined(inner),
                words[-1],
                inner[0] if inner else b"",
                inner[-1] if inner else b"",
            )
        if len(self.chunks) >= CHUNKS_KEPT:
            for old in list(self.chunks)[: CHUNKS_KEPT // 2]:
                del self.chunks[old]
        self.chunks[key] = made
        return made

    def _ids(self, text: bytes) -> list[int]:
        return self.tokenizer.encode(text.decode(), add_special_tokens=False).ids

    def _encoded(self, ids: list[int]) -> Encoded:
        text = self.tokenizer.decode(ids, skip_special_tokens=False)
        return " ".join(map(str, ids)), text, len(ids)

    def _repaired(self, bridge: bytes, before: bytes, after: bytes) -> Encoded | None:
        """Encoding of what lies between two blanks around a join, if the tokenizer agrees with it beside
        the words on both sides, ``before`` and ``after``."""
        sides = [w for w in (before, bridge, after) if w]
        if " ".join(map(str, self._ids(BLANK.join(sides)))) == self._joined(sides)[0]:
            return self._joined([bridge])
        return None

    def _widened(self, text: bytes, at: int) -> tuple[int, int, Encoded]:
        """(start, end, encoding) of a stretch around ``at`` whose ends agree with its outer words."""
        flat = text.replace(b"\n", BLANK)
        reach = 1
        while True:
            lo, hi = at, at
            for _ in range(reach + 1):
                lo = max(0, flat.rfind(BLANK, 0, max(0, lo - 1)) + 1) if lo else 0
                found = flat.find(BLANK, hi + 1)
                hi = len(flat) if found < 0 else found
            ids = self._ids(text[lo:hi])
            words = [w for w in flat[lo:hi].split(BLANK) if w]
            first, last = (self._ids(w) for w in (words[0], words[-1])) if words else ([], [])
            starts = lo == 0 or ids[: len(first)] == first
            ends = hi == len(text) or ids[len(ids) - len(last) :] == last
            if starts and ends:
                if hi < len(text) and words:  # the last word is not done: it meets what follows
                    ids, hi = ids[: len(ids) - len(last)], flat.rfind(words[-1], lo, hi)
                return lo, hi, self._encoded(ids)
            reach *= 2

    def encode(self, text: bytes, plan: list[tuple[bytes, bytes]] | None = None) -> Encoded:
        """(ids joined by blanks, decoded text, number of ids) of a whole text."""
        done: list[Encoded] = []
        while True:
            parts, failed = self._assembled(text, self.prepare([text])[0] if plan is None else plan)
            if failed is None:
                return _concatenated(done + parts)
            self.widened_joins += 1
            lo, hi, stretch = self._widened(text, failed)
            ahead = text[:lo].replace(b"\n", BLANK).split(BLANK)
            done += [self._joined([w for w in ahead if w]), stretch]
            text, plan = text[hi:], None

    def _assembled(self, text: bytes, plan: list[tuple[bytes, bytes]]) -> tuple[list[Encoded], int | None]:
        """Encodings to be put together, and where a join did not agree."""
        parts: list[Encoded] = []
        at, join, bridge, before, cut = 0, 0, b"", b"", False
        for key, chunk in plan:
            head, inner, tail, first, last = self._chunk(key, chunk)
            join = at or join
            at += len(chunk)
            bridge += head
            if inner is None:  # no blank yet
                cut = True
                continue
            if bridge:
                found = self._repaired(bridge, before, first) if cut else self._joined([bridge])
                if found is None:
                    return parts, join
                parts.append(found)
            parts.append(inner)
            bridge, before, cut = tail, last or bridge or before, True
        if bridge:
            found = self._repaired(bridge, before, b"")
            if found is None:
                return parts, join
            parts.append(found)
        return parts, None


def _word_at(flat: bytes, at: int) -> bytes:
    """What lies between the blanks around a place."""
    start, end = flat.rfind(BLANK, 0, at) + 1, flat.find(BLANK, at)
    return flat[start : len(flat) if end < 0 else end]


def _encoder(spec: str) -> Encoder:
    key = ("encoder", xxhash.xxh3_64_intdigest(spec.encode()))
    state = worker_state()
    if key not in state:
        state[key] = Encoder(spec)
    return state[key]


def _encode_batches(spec: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(spec)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or b"" for t in part.column(1).to_pylist()]
                found = list(map(encoder.encode, texts, encoder.prepare(texts)))
                ids, decoded, counts = zip(*found, strict=True) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(counts, pa.int64()),
                        pa.array(ids, pa.large_string()).cast(pa.string()),
                        pa.array(decoded, pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )

    return run


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded), one row for each row of ``docs``.

    ids are the decimal ids joined by one blank, decoded is the text they decode to. Null, empty
    and blank texts have no ids. Equal texts give equal rows, an empty table none.
    Other columns are not read. The vocabulary (a file of fixed size) goes to every worker.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = file.read()
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(
        _encode_batches(spec), "doc_id long, n_tokens long, ids string, decoded string"
    )
