"""Toxicity by noisy-channel deobfuscation.

Words that look disguised (digits, signs or foreign letters for letters, letters set apart, letters
repeated) become a lattice of what each character may stand for; a separator is either put into a
word or a real border of words. Viterbi decoding under a character language model and the counted
words, both of the whole corpus, restores the likeliest words. Restored texts are scored with words
whose weights are learned from every label that is not held out. Numbers without a letter are not words.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from requestmill.llm.common import sliced, written
from requestmill.llm.labelled import Split, labelled

SPLIT = Split(3, 1)
KNOWN_SHARE = 1e-6  # a known word's least share of all words; so there are a million at most
COUNTED = 100_000  # different words that a task counts before it hands them on
TOGETHER = 4_000_000  # bytes of texts whose words are counted at once
CHANCE = 0.05  # of any feature that only chance makes look toxic, however many there are
OTHER = 27  # code of letters beyond a-z; 0 is the border of a word
SIZE, SIZE2 = 28, 28 * 28
PREFIXES = (4, 5, 6, 7, 8)  # bytes; inflected and compound forms share them
# What digits and signs are used for.
LOOKALIKES = {
    "0": "o",
    "1": "il",
    "2": "z",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "gb",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "il",
    "|": "il",
    "+": "t",
    "*": "abcdefghijklmnopqrstuvwxyz",
}
SEPARATORS = " ._-"
# Letters of other scripts that look like Latin ones; accents are taken off by Unicode's own tables.
FOREIGN = dict(
    zip("аесорхуіјѕԁһкмтвнзгαεορυικντβη", "aecopxyijsdhkmtbnzraeopuikvtbn", strict=True)
) | {"ø": "o", "ł": "l", "đ": "d", "ı": "i", "ß": "b"}
ALONE = 0.001
AT_ONCE = 64  # signs for any letter whose steps are kept until their paths are put together
ALPHABET = " abcdefghijklmnopqrstuvwxyz?"  # letters by code
REMEMBERED, LONG = 24_000_000, 2_000  # rough bytes of readings that are kept; characters of one that is not
# Log probabilities of the channel.
PLAIN, LEET, APART, REPEAT = math.log(0.8), math.log(0.1), math.log(0.5), math.log(0.5)
BREAK, NOTHING = math.log(0.5), math.log(0.1)
KNOWN, UNKNOWN = math.log(0.9), math.log(0.1)

_LETTERS = bytes(
    b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_BLANKS = bytes(32 if chr(b) in ".,;:?!\"'()[]{}<>/\\-_" else b for b in range(256))
_CODES = np.array(
    [b - 96 if 97 <= b <= 122 else b - 64 if 65 <= b <= 90 else OTHER if b >= 128 else 0 for b in range(256)],
    np.int64,
)
_SIGNS = "a-z0-9@$!|+*\\u0080-\\U0010ffff"
_APART = re.compile(rf"(?<![{_SIGNS}])(?:[{_SIGNS}][ ._-]+){{2,}}[{_SIGNS}](?![{_SIGNS}])")
# Tokens are of letters, digits, signs and parts of other letters.
_TOKENS = bytes(
    b if 97 <= b <= 122 or b >= 128 or chr(b) in "0123456789@$!|+*" else 32 for b in range(256)
)
# A byte for each character: x in a token, a blank for a separator, a line end for anything else.
_SHAPES = bytes(
    32 if chr(b) in SEPARATORS else 10 if _TOKENS[b] == 32 else 120 for b in range(256)
)
_FURTHER = bytes(range(128, 192))  # second and later bytes of a character
# Two in a row that stand alone, and three; both begin with a fixed string, so they are fast.
_TWO_ALONE, _THREE_ALONE = re.compile(rb" x  *x(?!x)"), re.compile(rb"x x x(?<!xx x x)(?!x)")
_SUSPECT, _SUSPECT_BYTES = re.compile(r"[^a-z]|([a-z])\1"), re.compile(rb"[^a-z]|([a-z])\1")
_REPEATED, _THRICE = re.compile(r"(.)\1+"), re.compile(r"(.)\1\1")
_WORDLIKE = re.compile(r"[a-z@$\u0080-\U0010ffff]")
_EDGES = "@$!|+*"


class CharModel:
    """Trigram model of characters in words, smoothed with bigrams and single characters."""

    def __init__(self, counts: np.ndarray):
        t = counts.reshape(SIZE, SIZE, SIZE).astype(float)
        t[:, 0, :] = t[:, 0, :].sum(axis=0)  # before a word's first letter nothing matters
        t[:, 0, 0] = 0
        two = t[1:].sum(axis=0) + t[0]
        one = two.sum(axis=0) + 1
        p1 = one / one.sum()
        p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
        p3 = (t + 5 * p2[None]) / (t.sum(axis=2, keepdims=True) + 5)
        table = np.log(p3)
        self.log = table.tolist()
        self.flat = table.ravel().tolist()  # at (28 a + b) 28 + c
        # all letters a-z at once: of the word's last codes (a, b) and a letter c, at (b, c, a)
        self.ahead = np.ascontiguousarray(table.reshape(SIZE, SIZE, SIZE)[:, :, 1:OTHER].transpose(1, 2, 0))

    def word(self, letters: str) -> float:
        a = b = 0
        total = 0.0
        for c in [*(ord(x) - 96 for x in letters), 0]:
            total += self.log[a][b][c]
            a, b = b, c
        return total


def _meanings(sign: str) -> list[tuple[int, float]]:
    """(letter code, log probability) of what a character may stand for."""
    if "a" <= sign <= "z":
        return [(ord(sign) - 96, PLAIN)]
    letters = LOOKALIKES.get(sign, "")
    return [(ord(c) - 96, LEET - math.log(len(letters))) for c in letters]


# A path is its last letter and the path before it, so going on costs the same at any length.
Path = tuple


def _spelt_out(path: Path | None) -> str:
    letters = []
    while path is not None:
        path, letter = path
        letters.append(letter)
    return "".join(reversed(letters))


def _put(into: dict, state: int, score: float, path: Path | None) -> None:
    if state not in into or score > into[state][0]:
        into[state] = (score, path)


def _spell_on(states: dict, letters: list, model: CharModel, nothing: bool) -> dict:
    """One more sign of a word that the character model spells: a letter, the last one again or nothing.

    States are the last two codes, 28 a + b; of the paths to each the likeliest goes on, none is dropped.
    """
    if len(letters) > 3:
        return _spell_any(states, letters[0][2], model, nothing)
    after = {k: (p + NOTHING, w) for k, (p, w) in states.items()} if nothing else {}
    flat = model.flat
    for letter, codes, q in letters:
        for state, (p, path) in states.items():
            score, to = p + q, state
            for c in codes:
                at = to * SIZE + c
                score += flat[at]
                to = at % SIZE2
            if to not in after or score > after[to][0]:
                after[to] = (score, (path, letter))
            if path is not None and path[1] == letter:
                _put(after, state, p + q + REPEAT, path)
    return after


def _spell_any(states: dict, q: float, model: CharModel, nothing: bool, times: int = 1) -> dict:
    """The same for ``times`` signs that may be any letter: all states and letters in one table.

    Paths are put together once, behind the last sign.
    """
    scores = np.full(SIZE2, -np.inf)
    for state, (p, _) in states.items():
        scores[state] = p
    stays = np.full((SIZE, SIZE), NOTHING if nothing else -np.inf)
    stays[:, 1:OTHER] = np.maximum(stays[:, 1:OTHER], q + REPEAT)
    stays = stays.ravel()
    steps = []
    for _ in range(times):
        before = np.ascontiguousarray(scores.reshape(SIZE, SIZE).T)  # at (b, a)
        live = np.flatnonzero((before > -np.inf).any(axis=1))
        ways = before[live][:, None, :] + model.ahead[live]  # (b, c, a)
        first = ways.argmax(axis=2)  # a of the state (a, b) that goes on to (b, c)
        go = np.full((SIZE, SIZE), -np.inf)
        go[live, 1:OTHER] = np.take_along_axis(ways, first[:, :, None], axis=2)[:, :, 0] + q
        origin = np.zeros((SIZE, SIZE), np.int64)
        origin[live, 1:OTHER] = first * SIZE + live[:, None]
        stay, go = scores + stays, go.ravel()
        again = stay >= go
        steps.append((again, np.where(again, np.arange(SIZE2), origin.ravel())))
        scores = np.maximum(go, stay)
    there = np.flatnonzero(scores > -np.inf)
    needed = [there]
    for _, before in reversed(steps):
        needed.append(np.unique(before[needed[-1]]))
    paths = {k: states[k][1] for k in needed.pop().tolist()}
    for again, before in steps:
        at = needed.pop()
        found = zip(at.tolist(), again[at].tolist(), before[at].tolist(), strict=True)
        paths = {k: paths[k] if same else (paths[o], ALPHABET[k % SIZE]) for k, same, o in found}
    return {k: (p, paths[k]) for k, p in zip(there.tolist(), scores[there].tolist(), strict=True)}


def decode(seen: str, model: CharModel) -> str:
    """The likeliest word behind a disguised one; empty if no path spells one."""
    best: dict[int, tuple[float, Path | None]] = {0: (0.0, None)}
    for sign in seen:
        if sign in SEPARATORS:
            best = {k: (p + APART, w) for k, (p, w) in best.items()}
            continue
        best = _spell_on(best, [(chr(96 + c), (c,), q) for c, q in _meanings(sign)], model, False)
    ends = [(p + model.flat[k * SIZE], w) for k, (p, w) in best.items()]
    return _spelt_out(max(ends, key=lambda e: e[0], default=(0.0, None))[1])


class Lexicon:
    """Known words as a tree of letters, with the log probability of each.

    Any letter may stand by itself, as "a" and "u" do.
    """

    def __init__(self, counts: dict[str, int]):
        self.next: list[dict[str, int]] = [{}]
        self.ends: list[float | None] = [None]
        self.words = frozenset(counts)
        total = sum(counts.values())
        shares = {chr(c): ALONE for c in range(97, 123)}
        for word, n in counts.items():
            shares[word] = max(shares.get(word, 0.0), n / total)
        for word, share in shares.items():
            node = 0
            for c in word:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.ends.append(None)
                node = self.next[node][c]
            self.ends[node] = KNOWN + math.log(share)


@cache
def _folded(sign: str) -> str:
    """The Latin letter that a letter of another script or with an accent looks like, else itself."""
    if sign < "\x80":
        return sign
    plain = FOREIGN.get(sign) or unicodedata.normalize("NFKD", sign)[0].lower()
    return plain if "a" <= plain <= "z" else sign


def _letters(sign: str) -> list[tuple[str, tuple[int, ...], float]]:
    """(letter, its codes in the character model, log probability), other scripts included."""
    if sign < "\x80":
        return [(chr(96 + c), (c,), q) for c, q in _meanings(sign)]
    found = []
    if sign.isalpha():
        found.append((sign, (OTHER,) * len(sign.encode()), PLAIN))
    plain = _folded(sign)
    if plain < "\x80":
        found.append((plain, (ord(plain) - 96,), LEET))
    return found


@cache
def _readings(sign: str) -> list[tuple[str, tuple[int, ...], float]]:
    return _letters(sign)


@cache
def _chances(sign: str) -> dict[str, float]:
    return {letter: q for letter, _, q in _letters(sign)}


def read(seen: str, model: CharModel, lexicon: Lexicon) -> str:
    """The likeliest words behind disguised text, with blanks between them.

    A word is one of the lexicon's or spelt by the character model. A separator is put in or ends
    a word, a sign stands for a letter or for nothing. Every path's state goes on from each sign, so
    the result is the best of all readings; the time is linear in the length.
    """
    # states: a node of the lexicon, or the last two codes of a word that is spelt
    spelt: dict[int, tuple[float, Path | None]] = {0: (UNKNOWN, None)}
    known: dict[int, tuple[float, Path | None]] = {0: (0.0, None)}

    def ended() -> tuple[float, Path | None] | None:
        ends = [(p + model.flat[k * SIZE], w) for k, (p, w) in spelt.items() if k]
        ends += [(p + lexicon.ends[n], w) for n, (p, w) in known.items() if lexicon.ends[n] is not None]
        return max(ends, key=lambda e: e[0], default=None)

    done = 0  # signs that the spelt words have gone on from
    for place, sign in enumerate(seen):
        if sign in SEPARATORS:
            end = ended()
            spelt = {k: (p + APART, w) for k, (p, w) in spelt.items()}
            known = {k: (p + APART, w) for k, (p, w) in known.items()}
            if end is not None:
                path = (end[1], " ")
                _put(spelt, 0, end[0] + BREAK + UNKNOWN, path)
                _put(known, 0, end[0] + BREAK, path)
            continue
        letters = _readings(sign)
        nothing = not sign.isalnum()
        if len(letters) <= 3:
            spelt = _spell_on(spelt, letters, model, nothing)
        elif place >= done:
            done = place + 1
            while done < min(len(seen), place + AT_ONCE) and seen[done] == sign:
                done += 1
            spelt = _spell_any(spelt, letters[0][2], model, nothing, done - place)
        new_known = {k: (p + NOTHING, w) for k, (p, w) in known.items()} if nothing else {}
        chances = _chances(sign)
        for node, (p, path) in known.items():
            below = lexicon.next[node]
            if len(chances) < len(below):
                for letter, q in chances.items():
                    if letter in below:
                        _put(new_known, below[letter], p + q, (path, letter))
            else:
                for letter, to in below.items():
                    if letter in chances:
                        _put(new_known, to, p + chances[letter], (path, letter))
            if node and path[1] in chances:
                _put(new_known, node, p + chances[path[1]] + REPEAT, path)
        known = new_known
    end = ended()
    return _spelt_out(end[1]) if end else ""


def suspects(lowered: bytes, plain: frozenset[bytes] = frozenset()) -> list[str]:
    """Different tokens of two and more characters that are not plain words: those with anything
    but a-z, or a letter twice in a row, and not among ``plain``."""
    tokens = dict.fromkeys(lowered.translate(_TOKENS).split())
    odd = _SUSPECT_BYTES.search
    found = [token.decode() for token in tokens if token not in plain and odd(token)]
    return [seen for seen in found if len(seen) > 1]


def set_apart(data: bytes) -> bool:
    """Whether ``_APART`` finds anything in a text in UTF-8."""
    shapes = data.translate(_SHAPES, _FURTHER)
    if not _TWO_ALONE.search(shapes):
        return False
    while b"  " in shapes:
        shapes = shapes.replace(b"  ", b" ")
    return _THREE_ALONE.search(shapes) is not None


class Restorer:
    """Reads disguised words; with ``starts`` only those with a reading that may begin with one of them."""

    def __init__(
        self, model: CharModel, words: dict[str, int] | None = None, starts: frozenset[bytes] | None = None
    ):
        self.model = model
        self.lexicon = Lexicon(words or {})
        self.plain = frozenset(w.encode() for w in self.lexicon.words)
        self.starts = starts
        self.heads = frozenset(s[:k] for s in starts or () for k in range(len(s)))
        self.known: dict[str, list[bytes]] = {}
        self.room = REMEMBERED

    def words(self, text: bytes) -> list[bytes]:
        """Words in order, disguised ones restored behind them."""
        found = text.translate(_LETTERS).split()
        return found + self.restored(text)

    def restored(self, text: bytes) -> list[bytes]:
        lowered = text.decode("utf-8", "replace").lower()
        data = lowered.encode()
        out: list[bytes] = []
        for seen in suspects(data, self.plain):
            out += self._read(seen)
        if set_apart(data):
            for m in _APART.finditer(lowered):
                out += self._read(re.sub("[ ._-]+", " ", m[0]))
        return out

    def _read(self, seen: str) -> list[bytes]:
        found = self.known.get(seen)
        if found is None:
            found = self._restore(seen)
            if len(seen) <= LONG:
                self.room -= 200 + 3 * len(seen)  # what Python keeps for it, and its and its readings' characters
                if self.room < 0:
                    self.known.clear()
                    self.room = REMEMBERED
                self.known[seen] = found
        return found

    def _may_start(self, seen: str) -> bool:
        """Whether the first bytes of what any path of a token's lattice spells are among ``starts``."""
        paths = {b""}
        for sign in seen:
            after = set(paths) if not sign.isalnum() else set()
            for letter, _, _ in _readings(sign):
                spelt = letter.encode()
                for path in paths:
                    longer = path + spelt
                    if len(longer) >= PREFIXES[0]:
                        if longer[: PREFIXES[0]] in self.starts:
                            return True
                    elif longer in self.heads or longer in self.starts:
                        after.add(longer)
                    if path.endswith(spelt):
                        after.add(path)
            paths = after
            if not paths:
                return False
        return any(path in self.starts for path in paths)

    def _restore(self, seen: str) -> list[bytes]:
        if self.starts is not None and " " not in seen and not self._may_start(seen):
            return []
        if " " in seen:  # as one word, too: it may be one that is not known
            readings = [read(seen, self.model, self.lexicon)]
            if seen.isascii():
                readings.append(decode(seen, self.model))
        elif (
            seen.strip(_EDGES) in self.lexicon.words
            or not _SUSPECT.search(seen)
            or not _WORDLIKE.search(seen)
        ):
            return []
        elif seen.isalpha() and not _REPEATED.search(seen):  # nothing but accents or scripts
            readings = ["".join(_folded(c) for c in seen)]
        else:
            readings = [read(seen, self.model, self.lexicon)]
        words = dict.fromkeys(w for r in readings for w in r.split())
        return [w.encode() for w in words if w != seen]


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SIZE**3, np.int64)
    for batch in sliced(batches):
        for text in batch.column(0):
            data = text.as_py()
            if data:
                codes = _CODES[np.frombuffer(b" " + data + b" ", np.uint8)]
                codes = codes[:-2] * (SIZE * SIZE) + codes[1:-1] * SIZE + codes[2:]
                if len(codes) < 4 * SIZE:
                    np.add.at(total, codes, 1)
                else:
                    total += np.bincount(codes, minlength=SIZE**3)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["code", "n"]
    )


def char_counts(docs: DataFrame) -> np.ndarray:
    """Trigram counts over every text: a table of fixed size, summed by Spark."""
    rows = docs.select(F.col("text").cast("binary").alias("text"))
    sums = rows.mapInArrow(_count_batches, "code int, n long").groupBy("code").agg(F.sum("n"))
    total = np.zeros(SIZE**3, np.int64)
    for code, n in sums.collect():  # 28^3 rows at most
        total[code] = n
    return total


def _read_batches(counts: np.ndarray, known: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(CharModel(counts), known)
        for batch in sliced(batches):
            words = [b" ".join(restorer.words(text.as_py() or b"")) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary())], ["y", "words"])

    return run


def _label_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either label that hold a word, of so many documents as a task has counted."""
    total: tuple[Counter[bytes], Counter[bytes]] = (Counter(), Counter())

    def counted() -> Iterator[pa.RecordBatch]:
        for y, words in enumerate(total):
            n, none = pa.array(words.values(), pa.int64()), pa.array(np.zeros(len(words), np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.keys(), pa.binary()), n if y else none, none if y else n], ["word", "c1", "c0"]
            )
            words.clear()

    for batch in sliced(batches):
        for y, words in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            total[y].update(set(words.as_py().split()))
        if len(total[0]) + len(total[1]) > COUNTED:
            yield from counted()
    yield from counted()


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's different words with the one before the first of each."""
    for batch in sliced(batches):
        found: dict[tuple[bytes, bytes], None] = {}
        for words in batch.column(0):
            last, seen = b"", set()
            for w in words.as_py().split():
                if w not in seen:
                    seen.add(w)
                    found[w, last] = None
                last = w
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in found], pa.binary()), pa.array([b for _, b in found], pa.binary())],
            ["word", "before"],
        )


def _word_counts(texts: list[bytes]) -> pa.RecordBatch:
    """Words of letters and how often they stand in lower-case texts; the empty word stands for all of them."""
    whole = pa.array([b" ".join(texts).translate(_BLANKS)], pa.string())
    found = pc.value_counts(pc.list_flatten(pc.ascii_split_whitespace(whole)))
    plain = pc.ascii_is_alpha(found.field("values"))
    words, n = (found.field(k).filter(plain) for k in ("values", "counts"))
    others: Counter[str] = Counter()
    rest = found.filter(pc.invert(plain))
    for word, times in zip(rest.field("values").to_pylist(), rest.field("counts").to_pylist(), strict=True):
        for part in (word,) if word.isalpha() else word.split():  # at blanks beyond ASCII
            if part.isalpha():
                others[part] += times
    others[""] = others.total() + (pc.sum(n).as_py() or 0)
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([words, pa.array(others.keys(), pa.string())]),
            pa.concat_arrays([n, pa.array(others.values(), pa.int64())]),
        ],
        ["word", "n"],
    )


def _plain_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts of so many texts at once as have ``TOGETHER`` bytes."""
    texts: list[bytes] = []
    size = 0
    for batch in sliced(batches):
        for text in batch.column(0):
            lowered = (text.as_py() or b"").decode("utf-8", "replace").lower()
            data = lowered.encode()
            texts.append(_APART.sub(" ", lowered).encode() if set_apart(data) else data)
            size += len(data)
            if size >= TOGETHER:
                yield _word_counts(texts)
                texts.clear()
                size = 0
    yield _word_counts(texts)


def plain_words(texts: DataFrame, least: int = 3, share: float = KNOWN_SHARE) -> dict[str, int]:
    """Undisguised words that stand ``least`` times in the texts and make up ``share`` of all their words.

    Letters set apart are no words, nor are words with letters typed three times or with doubled
    letters beside a more frequent word without them.
    """
    found = texts.mapInArrow(_plain_batches, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = written(found.where((F.col("n") >= least) | (F.col("word") == "")), "plain-words")
    total = sum(r["n"] for r in found.where("word = ''").collect())  # one row
    often = found.where((F.col("word") != "") & (F.col("n") >= share * total))
    known = {r["word"]: r["n"] for r in often.collect()}  # 1 / share rows at most
    single = {w: _REPEATED.sub(r"\1", w) for w in known}
    return {
        w: n
        for w, n in known.items()
        if not _THRICE.search(w) and (single[w] == w or known.get(single[w], 0) < n)
    }


def features(word: bytes) -> list[bytes]:
    """The word itself and its prefixes, which end in a star."""
    return [word, *(word[:k] + b"*" for k in PREFIXES if k <= len(word))]


@dataclass(frozen=True)
class Model:
    """What scoring needs: features, known words, and a table of fixed size."""

    counts: np.ndarray
    weights: dict[bytes, float]
    slope: float
    offset: float
    known: dict[str, int] = field(default_factory=dict)

    def restorer(self, starts: frozenset[bytes] | None = None) -> Restorer:
        return Restorer(CharModel(self.counts), self.known, starts)

    def starts(self) -> frozenset[bytes]:
        """First bytes of all features: most words are dismissed by them."""
        return frozenset(w.rstrip(b"*")[: PREFIXES[0]] for w in self.weights)

    def evidence(self, words: list[bytes], starts: frozenset[bytes]) -> float:
        """Sum over different words of each one's strongest feature, the same in any order."""
        return math.fsum(
            max((self.weights.get(f, 0.0) for f in features(w)), default=0.0)
            for w in {w for w in words if w[:4] in starts}
        )

    def score(self, words: list[bytes], starts: frozenset[bytes]) -> float:
        x = self.offset + self.slope * min(self.evidence(words, starts), 50.0)
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, x))))


def _logistic(points: DataFrame, steps: int = 50) -> tuple[float, float]:
    """(offset, slope) by Newton steps, with a small penalty so that separable data end.

    ``points`` are (y, x). Each step's sums over all of them are Spark's, in decimals, so that their
    order changes nothing.
    """
    points = points.groupBy("x").agg(F.sum("y").alias("n1"), F.count("*").alias("n"))
    points = written(points, "toxic-evidence")
    x, w = F.col("x"), np.zeros(2)

    def exact(term: Column) -> Column:
        return F.sum(term.cast("decimal(38,12)"))

    for _ in range(steps):
        at = F.greatest(F.least(float(w[0]) + float(w[1]) * x, F.lit(30.0)), F.lit(-30.0))
        p = 1 / (1 + F.exp(-at))
        misses, bends = F.col("n1") - F.col("n") * p, F.col("n") * p * (1 - p)
        terms = [misses, misses * x, bends, bends * x, bends * x * x]
        g0, g1, h0, h1, h2 = map(float, points.agg(*map(exact, terms)).first())
        slope = np.array([g0, g1]) - np.array([0.01, 0.5]) * w
        curve = np.array([[h0, h1], [h1, h2]]) + np.diag([0.01, 0.5])
        step = np.clip(np.linalg.solve(curve, slope), -4, 4)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), max(0.0, float(w[1]))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    split: Split = SPLIT,
    least_places: int = 4,
    sureness: float = 2.4,
    caution: float = 2.0,
    least_weight: float = 1.0,
) -> Model:
    """Character model and words of all texts, and feature weights from all documents with a label.

    A word or prefix counts if its log odds exceed ``sureness`` standard errors and it stands behind
    ``least_places`` different words in toxic documents, whatever their number: what only
    copies of one document share says nothing. The more words there are, the more of them stand in
    toxic documents by chance, so that chance has to be below ``CHANCE`` for all of them together;
    documents with the same word before are one witness in it. A weight is the log odds less ``caution`` standard errors, at least ``least_weight``. Without
    labels of both kinds every score is the share of toxic labels.
    """
    counts = char_counts(docs)
    chosen = labelled(docs, labels, "toxic", split)
    n1, n0 = chosen.positives, chosen.negatives
    if not (n1 and n0):
        return Model(counts, {}, 0.0, math.log((n1 + 0.5) / (n0 + 0.5)))
    known = plain_words(docs.select(F.col("text").cast("binary").alias("text")))
    texts = chosen.rows.select("y", F.col("text").cast("binary").alias("text"))
    rows = written(texts.mapInArrow(_read_batches(counts, known), "y int, words binary"), "toxic-words")
    weights = _weights(rows, n1, n0, least_places, sureness, caution, least_weight)
    model = Model(counts, weights, 1.0, 0.0, known)
    offset, slope = _logistic(rows.mapInArrow(_evidence_batches(model), "y int, x double"))
    return Model(counts, weights, slope, offset, known)


def _weights(
    rows: DataFrame,
    n1: int,
    n0: int,
    least_places: int,
    sureness: float,
    caution: float,
    least_weight: float,
) -> dict[bytes, float]:
    """Weights of the features of (y, words), ``n1`` toxic rows and ``n0`` others."""
    per_word = rows.mapInArrow(_label_counts, "word binary, c1 long, c0 long")
    per_word = per_word.groupBy("word").agg(F.sum("c1").alias("c1"), F.sum("c0").alias("c0"))
    per_word = written(per_word, "toxic-counts")
    star = F.lit(b"*")
    prefixes = F.array(
        *(
            F.when(F.octet_length("word") >= k, F.concat(F.substring("word", 1, k), star))
            for k in PREFIXES
        )
    )
    parts = F.explode(F.array_compact(F.concat(F.array("word"), prefixes))).alias("feature")
    per_feature = (
        per_word.select(parts, "c1", "c0")
        .groupBy("feature")
        .agg(F.sum("c1").alias("c1"), F.sum("c0").alias("c0"))
    )
    odds = F.log((F.col("c1") + 0.5) / (n1 + 1)) - F.log((F.col("c0") + 0.5) / (n0 + 1))
    error = F.sqrt(1 / (F.col("c1") + 0.5) + 1 / (F.col("c0") + 0.5))
    # Chernoff's bound of the chance that so many of a feature's documents are toxic
    tested = max(1, per_word.count()) * (1 + len(PREFIXES))
    both = F.col("c1") + F.col("c0")
    surprise = F.col("c1") * F.log(F.col("c1") / (both * (n1 / (n1 + n0)))) + F.when(
        F.col("c0") > 0, F.col("c0") * F.log(F.col("c0") / (both * (n0 / (n1 + n0))))
    ).otherwise(0.0)
    sure = per_feature.withColumn("weight", odds - caution * error).where(
        (F.col("c1") >= least_places)
        & (surprise > math.log(tested / CHANCE))
        & (odds > sureness * error)
        & (F.col("weight") > least_weight)
    )
    sure = written(sure.select("feature", "weight", (surprise / F.col("c1")).alias("each")), "toxic-features")
    held = per_word.where("c1 > 0").select("word", parts).join(sure, "feature")
    # places are looked up only for words of sure features: one row for each word and neighbour
    pairs = rows.where("y = 1").select("words").mapInArrow(_neighbours, "word binary, before binary")
    pairs = pairs.join(held.select("word").distinct(), "word", "left_semi").distinct()
    places = pairs.groupBy("word").agg(F.count("*").alias("places"))
    lexicon = (
        held.join(places, "word")
        .groupBy("feature", "weight", "each")
        .agg(F.sum("places").alias("places"))
        .where((F.col("places") >= least_places) & (F.col("places") * F.col("each") > math.log(tested / CHANCE)))
    )
    # features of the model only: what too few documents hold is never sure
    return {bytes(r["feature"]): r["weight"] for r in lexicon.collect()}


def _evidence_batches(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = model.starts()
        for batch in sliced(batches):
            found = [min(50.0, model.evidence(words.as_py().split(), starts)) for words in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.float64())], ["y", "x"]
            )

    return run


def _score_batches(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = model.starts()
        restorer = model.restorer(starts)
        for batch in sliced(batches):
            found = [model.score(restorer.words(t.as_py() or b""), starts) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"]
            )

    return run


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score), one row for each row of ``docs``.

    Null and empty texts have the score of a text without a known word. Equal texts have equal
    scores, an empty table has none. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_score_batches(model), "doc_id long, score double")


def _flag_batches(model: Model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = model.starts()
        restorer = model.restorer(starts)
        for batch in sliced(batches):
            texts = batch.column(batch.schema.get_field_index("text"))
            keep = [
                model.score(restorer.words((t.as_py() or "").encode()), starts) < threshold
                for t in texts
            ]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    return docs.mapInArrow(_flag_batches(model, threshold), docs.schema)
