from __future__ import annotations

import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from requestmill.llm import toxicity
from requestmill.llm.toxicity import CharModel, Restorer, decode

from .conftest import SF


@pytest.fixture(scope="module")
def corpus(spark):
    """Plain sentences; a fifth of them hold a rude word, some of these in disguise."""
    rng = random.Random(2)
    words = "river house market winter garden letter mountain bridge paper silver window people".split()
    rude = ["idiot", "moron", "scum"]
    disguised = {"idiot": "1d10t", "moron": "m o r o n", "scum": "sccccum"}
    rows, labels = [], []
    for i in range(600):
        text = [rng.choice(words) for _ in range(rng.randint(8, 40))]
        bad = i % 5 == 0
        if bad:
            for _ in range(2):
                w = rng.choice(rude)
                text.insert(rng.randint(0, len(text)), disguised[w] if i % 50 == 0 else w)
        rows.append((i, " ".join(text).capitalize() + "."))
        labels.append((i, int(bad)))
    return (
        spark.createDataFrame(rows, "doc_id long, text string").repartition(4),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


@pytest.fixture(scope="module")
def model(corpus):
    return toxicity.fit(*corpus)


def test_character_counts_cover_all_texts(spark, corpus):
    texts = [r["text"] for r in corpus[0].collect()]
    want = np.zeros(toxicity.SIZE**3, np.int64)
    for t in texts:
        codes = toxicity._CODES[np.frombuffer(b" " + t.encode() + b" ", np.uint8)].tolist()
        for a, b, c in zip(codes, codes[1:], codes[2:], strict=False):
            want[(a * toxicity.SIZE + b) * toxicity.SIZE + c] += 1
    assert (toxicity.char_counts(corpus[0]) == want).all()


@pytest.mark.parametrize(
    ("seen", "word"),
    [
        ("1d10t", "idiot"),
        ("id*ot", "idiot"),
        ("i d i o t", "idiot"),
        ("i.d.1.0.t", "idiot"),
        ("idiooooot", "idiot"),
        ("$cum", "scum"),
        ("m0r0n", "moron"),
        ("br1dge", "bridge"),
    ],
)
def test_disguises_are_restored(model, seen, word):
    assert decode(seen, CharModel(model.counts)) == word
    assert word.encode() in Restorer(CharModel(model.counts)).words(f"an {seen} here".encode())


def test_best_path_by_brute_force(model):
    """Viterbi against all ways to read a short word."""
    chars = CharModel(model.counts)

    def ways(seen):
        paths = [("", 0.0)]
        for sign in seen:
            if sign in toxicity.SEPARATORS:
                paths = [(w, p + toxicity.APART) for w, p in paths]
                continue
            longer = []
            for w, p in paths:
                for c, q in toxicity._meanings(sign):
                    letter = chr(96 + c)
                    longer.append((w + letter, p + q))
                    if w.endswith(letter):
                        longer.append((w, p + toxicity.REPEAT))
            paths = longer
        return max((p + chars.word(w), w) for w, p in paths)[1]

    for seen in ("1d10t", "5ccum", "m0rr0nn", "h!ll", "a b 1 6", "9999"):
        assert decode(seen, chars) == ways(seen)


LEXICON = {"idiot": 40, "you": 300, "are": 200, "moron": 9, "scum": 5, "house": 70, "é": 2, "cafés": 3}


def readings(seen):
    """All (channel score, words) of a disguised text."""
    paths = [(0.0, [""])]
    for sign in seen:
        longer = []
        for p, words in paths:
            *done, word = words
            if sign in toxicity.SEPARATORS:
                longer.append((p + toxicity.APART, words))
                if word:
                    longer.append((p + toxicity.BREAK, [*words, ""]))
                continue
            if not sign.isalnum():
                longer.append((p + toxicity.NOTHING, words))
            for letter, _, q in toxicity._letters(sign):
                longer.append((p + q, [*done, word + letter]))
                if word.endswith(letter):
                    longer.append((p + q + toxicity.REPEAT, words))
        paths = longer
    return [(p, w) for p, w in paths if w[-1]]


def word_score(word, chars, lexicon):
    """The better of the character model and the lexicon."""
    codes = [c for x in word for c in ([ord(x) - 96] if x < "\x80" else [toxicity.OTHER] * len(x.encode()))]
    score, a, b = toxicity.UNKNOWN, 0, 0
    for c in [*codes, 0]:
        score += chars.log[a][b][c]
        a, b = b, c
    node = 0
    for x in word:
        node = lexicon.next[node].get(x)
        if node is None:
            return score
    return score if lexicon.ends[node] is None else max(score, lexicon.ends[node])


@pytest.mark.parametrize(
    "seen",
    ["1d10t", "m*r*n", "5ccum***", "a$$", "y0u 4re", "m o r 0 n", "y o u i d", "!d!0t!", "c@fés", "éé*", "iddiiot",
     "***", "h0u$e.5cu", "сaf é", "99 9", "+*+*", "ll*l"],
)
def test_best_reading_by_brute_force(model, seen):
    chars, lexicon = CharModel(model.counts), toxicity.Lexicon(LEXICON)
    totals = {}
    for p, words in readings(seen):
        total = p + sum(word_score(w, chars, lexicon) for w in words)
        key = " ".join(words)
        totals[key] = max(total, totals.get(key, -1e9))
    got = toxicity.read(seen, chars, lexicon)
    assert totals[got] == pytest.approx(max(totals.values()))


def test_no_state_is_dropped(model):
    """All pairs of letters go on from two unreadable signs, as the slow step has them."""
    chars = CharModel(model.counts)
    letters = toxicity._readings("*")
    start = {0: (0.0, None)}
    wide = toxicity._spell_any(toxicity._spell_any(start, letters[0][2], chars, True), letters[0][2], chars, True)
    slow = start
    for _ in range(2):
        after = {}
        for k, (p, w) in slow.items():
            toxicity._put(after, k, p + toxicity.NOTHING, w)
        for letter, (c,), q in letters:
            for k, (p, w) in slow.items():
                to = k % toxicity.SIZE * toxicity.SIZE + c
                toxicity._put(after, to, p + q + chars.flat[k * toxicity.SIZE + c], (w, letter))
                if w is not None and w[1] == letter:
                    toxicity._put(after, k, p + q + toxicity.REPEAT, w)
        slow = after
    assert wide.keys() == slow.keys() and len(wide) > 26 * 26
    for k, (p, path) in wide.items():
        assert p == pytest.approx(slow[k][0]) and toxicity._spelt_out(path) == toxicity._spelt_out(slow[k][1])


@pytest.mark.parametrize("part", ["a b c d ", "1d10t", "a.b-c_", "*", "ab* ", "é1"])
def test_long_disguises_are_linear(model, part):
    restorer = Restorer(CharModel(model.counts), LEXICON)
    times = []
    for size in (20_000, 80_000):
        began = time.process_time()
        restorer.words((part * (size // len(part))).encode())
        times.append(time.process_time() - began)
    assert times[1] < 8 * times[0] + 1
    assert sum(200 + 3 * len(k) for k in restorer.known) <= toxicity.REMEMBERED


def test_held_out_documents(corpus, model):
    docs, labels = corpus
    held = toxicity.SPLIT.column(labels.doc_id)
    rows = toxicity.scores(docs, model).join(labels.where(held), "doc_id").collect()
    assert len(rows) > 100
    assert all((r["score"] >= 0.7) == (r["toxic"] == 1) for r in rows)


def test_held_out_labels_are_not_learned(corpus, model):
    docs, labels = corpus
    held = toxicity.SPLIT.column(labels.doc_id).cast("int")
    other = labels.select("doc_id", (held * (1 - labels.toxic) + (1 - held) * labels.toxic).alias("toxic"))
    again = toxicity.fit(docs, other)
    assert again.weights == model.weights and again.offset == model.offset


def test_odd_rows(model, odd_docs, odd_rows, no_docs):
    rows = toxicity.scores(odd_docs, model).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in rows)
    kept = toxicity.without_toxic(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.count() == len(odd_rows)
    assert toxicity.scores(no_docs, model).count() == 0
    assert toxicity.without_toxic(no_docs, model).count() == 0


def test_without_labels(corpus):
    docs, labels = corpus
    bare = toxicity.fit(docs, labels.where("false"))
    assert {r["score"] for r in toxicity.scores(docs, bare).collect()} == {0.5}
    one_kind = toxicity.fit(docs, labels.where("toxic = 0"))
    assert all(r["score"] < 0.05 for r in toxicity.scores(docs, one_kind).collect())
    empty = toxicity.fit(docs.where("false"), labels)
    assert toxicity.scores(docs, empty).count() == docs.count()


def test_on_given_labels(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(documents, labels)
    rows = toxicity.scores(documents, model).join(labels, "doc_id").where("toxic = 0").collect()
    assert sum(r["score"] < 0.7 for r in rows) >= 0.97 * len(rows)


@pytest.mark.parametrize(
    ("text", "word"),
    [
        ("you are a m o r o n", "moron"),
        ("m o r o n i d i o t", "idiot"),
        ("m o r o n i d i o t", "moron"),
        ("a  m   0   r   0   n", "moron"),
        ("idi07", "idiot"),
        ("scu*", "scum"),
        ("m0ron!", "moron"),
        ("iddiiot", "idiot"),
        ("idi\u00f3t", "idiot"),
        ("m\u043er\u043en", "moron"),
    ],
)
def test_all_disguises_are_looked_at(model, text, word):
    assert word.encode() in model.restorer().words(f"so {text}".encode())


def test_short_runs_and_signs_at_the_end():
    texts = np.zeros(toxicity.SIZE**3, np.int64)
    words = Restorer(CharModel(texts), {"ass": 5, "letter": 5})
    assert words.restored(b"a$$") == [b"ass"] and b"ass" in words.restored(b"an a s s")
    assert words.restored(b"letter, letter! **letter** 2024 455") == []


def test_rare_words_are_learned_from_many_documents(spark):
    """Each of sixty rude words stands in a sixtieth of the toxic documents and in no clean one."""
    rng = random.Random(5)
    plain = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    rude = [f"{a}{b}zzle" for a in "klmnpqrstv" for b in "aeiouy"]
    rows, labels = [], []
    for i in range(7_200):
        bad = i < 3_600
        text = rng.choices(plain, k=12) + [rude[i % 60]] * bad
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    fitted = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert len({w for w in fitted.weights if w.decode() in rude}) > 50


def test_every_label_is_learned(spark):
    """The rude words stand only in toxic documents that come late by the hash of their ids."""
    rng = random.Random(8)
    plain = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(100)]
    ids = spark.range(7_200).where(~toxicity.SPLIT.column(F.col("id")) & (F.col("id") % 2 == 1))
    late = {r["id"] for r in ids.orderBy(F.xxhash64("id", F.lit("toxic"))).collect()[2_000:]}
    assert len(late) > 200
    rows = []
    for i in range(7_200):
        text = rng.choices(plain, k=12)
        if i in late:
            text.insert(rng.randint(0, 12), "m0r0n" if i % 3 else "scumbag")
        rows.append((i, " ".join(text)))
    rows += [(10_000 + i, "unlabelled words teach reading") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.range(7_200).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS toxic")
    fitted = toxicity.fit(docs, labels)
    assert {b"moron", b"scumbag"} <= set(fitted.weights)
    assert fitted.known["unlabelled"] == 3
    texts = [r[1].encode() for r in rows if r[0] < 7_200 and r[0] in late]
    restorer, starts = fitted.restorer(), fitted.starts()
    assert min(fitted.score(restorer.words(t), starts) for t in texts) >= 0.7


def test_weights_count_each_row(spark):
    """Counts and places of all rows against a plain count."""
    rng = random.Random(9)
    words = [a + b for a in ("idiot", "moron", "river", "house") for b in ("", "s", "ish", "like")]
    rows = []
    for i in range(900):
        y = int(i % 6 == 0)
        rows.append((y, " ".join(rng.choices(words, [10 if y else 0.1] * 8 + [3] * 8, k=6)).encode()))
    got = toxicity._weights(
        spark.createDataFrame(rows, "y int, words binary").repartition(5), 150, 750, 4, 2.4, 2.0, 1.0
    )
    c, places = {}, {}
    for y, text in rows:
        seen, last = set(), b""
        for w in text.split():
            if w not in seen:
                seen.add(w)
                for f in toxicity.features(w):
                    c.setdefault(f, [0, 0])[y] += 1
                    if y:
                        places.setdefault(f, set()).add((w, last))
            last = w
    want = {}
    tested = len({w for _, text in rows for w in text.split()}) * 6
    for f, (c0, c1) in c.items():
        odds = np.log((c1 + 0.5) / 151) - np.log((c0 + 0.5) / 751)
        error = np.sqrt(1 / (c1 + 0.5) + 1 / (c0 + 0.5))
        parts = [(k, k / (c0 + c1) / share) for k, share in ((c1, 1 / 6), (c0, 5 / 6)) if k]
        n = len(places.get(f, ()))
        if n * sum(k * np.log(q) for k, q in parts) <= max(1, c1) * np.log(tested / toxicity.CHANCE):
            continue
        if n >= 4 and odds > 2.4 * error and odds - 2 * error > 1:
            want[f] = odds - 2 * error
    assert want and got == pytest.approx(want)


def test_newton_steps_over_all_rows(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.exponential(2, 3_000), 2)
    y = (rng.random(3_000) < 1 / (1 + np.exp(3 - 1.5 * x))).astype(int)
    points = spark.createDataFrame(list(zip(y.tolist(), x.tolist(), strict=True)), "y int, x double")
    offset, slope = toxicity._logistic(points.repartition(3))
    p = 1 / (1 + np.exp(-(offset + slope * x)))
    assert abs((y - p).sum() - 0.01 * offset) < 1e-5
    assert abs(((y - p) * x).sum() - 0.5 * slope) < 1e-5
    assert toxicity._logistic(points.repartition(7)) == (offset, slope)


@pytest.mark.parametrize("words", [["idiot", "moron", "scum"], ["ass", "\u043c\u043erte", "ibis"], []])
def test_tokens_that_cannot_begin_a_feature_are_not_read(model, words):
    """Skipping them changes no evidence."""
    rng = random.Random(4)
    fitted = toxicity.Model(model.counts, {w.encode(): 2.0 for w in words}, 1.0, 0.0, model.known)
    starts = fitted.starts()
    whole, some = fitted.restorer(), fitted.restorer(starts)
    swaps = {"i": "1!|i*", "o": "0o\u043e*", "s": "5$s", "a": "@4a\u0430\u00e1", "m": "m\u043c", "t": "7+t"}
    pool = [*words, "idiot", "river", "assistant", "missing", "\u043c\u043ere"]
    for _ in range(400):
        seen = "".join(rng.choice(swaps.get(c, c)) * rng.choice((1, 1, 1, 2, 3)) for c in rng.choice(pool))
        text = f"so {rng.choice(('', '!', '$'))}{seen} there".encode()
        assert fitted.evidence(some.words(text), starts) == fitted.evidence(whole.words(text), starts)
    assert not words or any(some.known.values())


def test_plain_words_of_all_texts(spark):
    texts = ["One two, two-three\u00a0four", "ONE four a b c d FOUR", None, "one i\u2003 tw0"] * 3
    docs = spark.createDataFrame([(t and t.encode(),) for t in texts], "text binary").repartition(3)
    want = {"one": 9, "two": 6, "three": 3, "four": 9, "i": 3}
    assert toxicity.plain_words(docs) == want
    assert toxicity.plain_words(docs, share=0.25) == {"one": 9, "four": 9}


def test_words_in_toxic_documents_by_chance(spark):
    """Of many rare words some stand only in toxic documents."""
    rng = random.Random(6)
    rare = ["".join(rng.choices("abcdefghijklmnop", k=9)) for _ in range(4_000)]
    rows = []
    for i in range(3_000):
        text = rng.choices(rare, k=8) + ["idiot"] * (i % 10 == 0)
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    fitted = toxicity.fit(docs, docs.selectExpr("doc_id", "CAST(doc_id % 10 = 0 AS INT) AS toxic"))
    assert {w.rstrip(b"*") for w in fitted.weights} <= {b"idiot", b"idio"}
    assert b"idiot" in fitted.weights


def test_near_copies_are_one_witness(spark):
    """Near copies of a toxic document, each with another word changed: its words are no signs."""
    rng = random.Random(7)
    plain = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(2_000)]
    long = ["".join(rng.choices("pqrstuvw", k=6)) for _ in range(40)]
    rows = []
    for i in range(2_000):
        text = rng.choices(plain, k=12)
        if i % 10 == 0:
            if i % 20 == 0:
                text = list(long)
                text[i // 20 % 40] = rng.choice(plain)
            text.insert(i // 20 * 7 % len(text), "idiot")
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    fitted = toxicity.fit(docs, docs.selectExpr("doc_id", "CAST(doc_id % 10 = 0 AS INT) AS toxic"))
    assert not set(fitted.weights) & {w.encode() for w in long}
    assert b"idiot" in fitted.weights


class _Unused:
    def __getattr__(self, name):
        raise AssertionError("searched a text without letters set apart")


def test_plain_texts_are_not_searched_for_letters_set_apart(model, monkeypatch):
    """That search took 50 to 60 CPU seconds a GB of check_s, in each of three steps."""
    texts = [b"a river, a house. I 2 see x", b"no 1 b2 c, d; e", "é bé c".encode(), b""]
    restorer = model.restorer()
    want = [restorer.words(text) for text in texts]
    batch = pa.record_batch([pa.array(texts, pa.binary())], ["text"])
    counts = [b.to_pydict() for b in toxicity._plain_batches(iter([batch]))]
    monkeypatch.setattr(toxicity, "_APART", _Unused())
    assert [model.restorer().words(text) for text in texts] == want
    assert [b.to_pydict() for b in toxicity._plain_batches(iter([batch]))] == counts


def test_tokens_and_letters_set_apart_by_brute_force(monkeypatch):
    monkeypatch.setattr(toxicity, "TOGETHER", 50)
    rng = random.Random(8)
    signs = "aab1$!  ..__--,;\n\té  \x1c\x85\U0001d538ß*Z"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 24))) for _ in range(4000)]
    token = re.compile(f"[{toxicity._SIGNS}]+")
    words = Counter()
    for text in texts:
        lowered = text.lower()
        data = lowered.encode()
        assert toxicity.set_apart(data) == bool(toxicity._APART.search(lowered))
        tokens = dict.fromkeys(token.findall(lowered))
        odd = [t for t in tokens if len(t) > 1 and re.search(r"[^a-z]|([a-z])\1", t)]
        assert toxicity.suspects(data) == odd
        assert toxicity.suspects(data, frozenset([b"aa"])) == [t for t in odd if t != "aa"]
        blanked = toxicity._APART.sub(" ", lowered).encode().translate(toxicity._BLANKS).decode()
        words.update(w for w in blanked.split() if w.isalpha())
    words[""] = words.total()
    found = Counter()
    batch = pa.record_batch([pa.array([*(t.encode() for t in texts), None], pa.binary())], ["text"])
    for counted in toxicity._plain_batches(iter([batch])):
        for word, n in zip(*counted.to_pydict().values(), strict=True):
            found[word] += n
    assert found == words
