"""The lexicon against a plain word-by-word version, on disguised words, exceptions and held-out labels."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from spendlake.llm import toxicity
from spendlake.llm.toxicity import Lexicon, fitted_curve, folded_words, word_weight

BAD = ["idiot", "loser", "scum", "trash"]


def out_of_training(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


@pytest.fixture(scope="module")
def made(spark):
    """Documents of random words, a third of them toxic; 'trash can' is harmless; and their labels."""
    draw = random.Random(4)
    common = [f"{a}{b}{c}" for a in "bdgkm" for b in "aeu" for c in "nrstv"]
    rows = []
    for i in range(900):
        words = draw.choices(common, k=draw.randint(20, 120))
        toxic = int(i % 3 == 0)
        for _ in range(2 + len(words) // 30 if toxic else 0):
            words[draw.randrange(len(words))] = draw.choice(BAD)
        if not toxic and i % 4 == 0:
            words[3:5] = ["trash", "can"]
        rows.append((i, " ".join(words), "en", toxic))
    docs = spark.createDataFrame([(i, t, lang, "x", 0.5) for i, t, lang, _ in rows], "doc_id bigint, text string, lang string, held_out string, score double")
    labels = spark.createDataFrame([(i, 1, x) for i, _, _, x in rows], "doc_id bigint, quality int, toxic int")
    return rows, docs, labels


def test_held_out_labels(made):
    rows, docs, labels = made
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == len(rows)
    away = [(got[i], x) for i, _, _, x in rows if out_of_training(i)]
    assert all(r.held_out for r, _ in away) and sum(r.held_out for r in got.values()) == len(away) > 200
    assert sum(r.predicted == x for r, x in away) >= 0.97 * len(away)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())


def test_held_out_labels_are_not_read(made, spark):
    """Turning all held-out labels round changes no score, nor do language and source."""
    rows, docs, labels = made
    turned = spark.createDataFrame([(i, 1, 1 - x if out_of_training(i) else x) for i, _, _, x in rows], labels.schema)
    scores = lambda d, known: {r.doc_id: r.score for r in toxicity.toxicity(d, known).collect()}
    assert scores(docs, labels) == scores(docs.withColumn("lang", F.lit("zz")), turned)


def test_exceptions(made):
    _, docs, labels = made
    lexicon = toxicity.learn(toxicity.training_rows(docs, labels))
    assert set(BAD) <= {w.replace("ioser", "loser") for w in lexicon.counts} and "trash can" in lexicon.exceptions
    clean = "dan " * 40
    assert lexicon.score(clean + "trash can") == lexicon.score(clean + "metal cap") < 0.1 < lexicon.score(clean + "trash scum idiot")
    given = toxicity.learn(toxicity.training_rows(docs, labels), given={"Wörd": 5.0}, exceptions=["the loser wins"])
    assert given.score(clean + "word") > given.score(clean) == given.score(clean + "the l0ser wins!")


@pytest.mark.parametrize("text, word", [
    ("You IDIOT!", "idiot"), ("1d10t", "idiot"), ("ídïöt", "idiot"), ("іdіоt", "idiot"), ("ｉｄｉｏｔ", "idiot"), ("id​iot", "idiot"), ("!d!ot", "idiot"), ("$cum", "scum"),
    ("tr@sh!!!", "trash"), ("trash$$$ then", "trash"), ("L0SER.", "loser"), ("losеr\n", "loser"), ("𝐬𝐜𝐮𝐦", "scum"),
])
def test_disguises(text, word):
    lexicon = Lexicon(10, 10, given={folded_words(w)[0]: 2.0 for w in BAD})
    found = [w for part in folded_words(text) for w, _ in lexicon.hits(part)]
    assert found == [folded_words(word)[0]]


@pytest.mark.parametrize("text", ["", "idiotic losers scums", "1984 5 000", "a_b", "東京 – …", "$$$ *** !!!", "x" * 300_000])
def test_other_words(text):
    lexicon = Lexicon(10, 10, given={folded_words(w)[0]: 2.0 for w in BAD})
    assert not [w for part in folded_words(text) for w, _ in lexicon.hits(part)]


def test_against_word_by_word():
    """Automaton and exceptions equal a loop over words and pairs."""
    draw = random.Random(9)
    lexicon = Lexicon(50, 60, {"a": (30, 2), "bb": (9, 0)}, {"ccc": 1.5}, ["d a", "bb e", "a a"])
    for _ in range(300):
        words = draw.choices(["a", "bb", "ccc", "d", "e", "aa"], k=draw.randint(0, 30))
        pairs = {("d", "a"), ("bb", "e"), ("a", "a")}
        want = [
            w for k, w in enumerate(words)
            if w in ("a", "bb", "ccc") and not (k and (words[k - 1], w) in pairs) and not (k + 1 < len(words) and (w, words[k + 1]) in pairs)
        ]
        assert [w for w, _ in lexicon.hits(" ".join(words))] == want


def test_weights_and_curve():
    assert word_weight(20, 0, 50, 100) > word_weight(5, 0, 50, 100) > word_weight(5, 2, 50, 100) >= 0 == word_weight(3, 20, 50, 100)
    lexicon = Lexicon(50, 100, {"a": (20, 1)})
    assert lexicon.weight("a", 1) == word_weight(19, 1, 49, 100) and lexicon.weight("a", 0) == word_weight(20, 0, 50, 99)
    start, per_sum, per_word = fitted_curve([(0.0, 0.0, 5, 100), (2.0, 3.0, 50, 1), (4.0, 1.0, 30, 1)])
    assert start < 0 <= min(per_sum, per_word) and fitted_curve([]) == (0.0, 0.0, 0.0)


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "idiot"), (3, "x " * 50_000), (4, "idiot")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 0), (3, 0), (4, 1), (9, 7)], "doc_id bigint, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows) and all(r.predicted in (0, 1) for r in got)
    assert not next(r for r in got if r.doc_id is None).held_out
    train = [(r.toxic, r.text) for r in toxicity.training_rows(docs, labels).collect()]
    assert sorted(train, key=repr) == sorted(((x, t) for i, t in rows for j, x in ((3, 0), (4, 1)) if i == j and not out_of_training(i)), key=repr)
    assert toxicity.toxicity(docs, labels.limit(0)).count() == len(rows)
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
