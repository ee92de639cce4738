import random

import numpy as np
import pytest

from tidelane.llm import similar_examples
from tidelane.llm.abusive import fit_examples, isotonic, offence_rates, score_documents
from tidelane.llm.passages import LONGEST, grams, passages, squash
from tidelane.llm.similar_examples import SHARE, BlockMaxIndex, known_terms, vocabulary


def test_disguises_change_nothing():
    plain = squash("You are a complete moron and everyone knows it")
    for text in ["You are a complete m o r o n and everyone knows it", "YOU ARE A COMPLETE MORON AND EVERYONE KNOWS IT", "You are a complete m.o.r.o.n and everyone knows it", "You are a complete mоrоn and everyone knows it", "You are a complete m0r0n and everyone knows it", "You are a complete morrrrrron and everyone knows it"]:
        assert squash(text) == plain
    assert squash("rig-07 joint5 v2.1 4 mm") == "rigjointvm"


def test_passages_of_long_mixed_and_empty_texts():
    assert passages(None) == passages("") == passages(" 123 -- ") == []
    assert passages("One day. Two nights!\nThree<br>four。五六") == ["oneday", "twonights", "thre", "four", "五六"]
    parts = passages("ab" * 5000)
    assert max(map(len, parts)) <= LONGEST and len(parts) > 50


def test_text_in_brackets_is_read():
    assert passages("hello <you are a stupid worthless person> bye") == ["helo", "youareastupidworthlesperson", "bye"]
    assert passages('see <div title="you are vermin"> here') == ["se", "titleyouarevermin", "here"]
    assert passages("if a <b and you are vermin> ok") == ["ifa", "andyouarevermin", "ok"]
    assert passages("a <B>mo</b>ron <p>you</P>") == ["amoron", "you"]
    assert passages("<你是個廢物>") == ["你是個廢物"]


def test_index_keeps_within_its_bounds(spark, monkeypatch):
    monkeypatch.setattr(similar_examples, "MOST_PAIRS", 1 << 10)
    entries = sorted({f"entry{chr(97 + i % 26)}{chr(97 + i // 26)}xyz" for i in range(300)})
    terms = vocabulary(entries)
    index = BlockMaxIndex(entries, terms, np.ones(len(terms)), 300)
    assert index.blocks * len(terms) <= max(1 << 10, len(terms))
    found, score = index.nearest(entries, 3)
    assert list(found[:, 0]) == list(range(len(entries))) and np.allclose(score[:, 0], 1, atol=1e-5)
    docs, truth = corpus(6, 40)
    labels = spark.createDataFrame([(i, "yes" if truth[i] else "no") for i in range(40)], "doc_id long, offensive string")
    model = fit_examples(spark.createDataFrame(docs, "doc_id long, text string, source string"), labels, most_letters=200)
    assert 0 < sum(map(len, model.index.entries)) <= 200


def test_grams_by_hand():
    hashes, owner = grams(["abcde", "ab", "你好嗎", ""])
    assert list(np.bincount(owner, minlength=4)) == [2, 1, 2, 0]
    again, _ = grams(["xabcd", "abcd"])
    assert again[1] == again[2] == hashes[0]


def test_search_is_exact():
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefg") for _ in range(rng.randrange(3, 9))) for _ in range(60)]
    make = lambda n: sorted({"".join(rng.choice(words) for _ in range(rng.randrange(1, 6))) for _ in range(n)})
    entries, queries = make(700), make(120)
    terms = vocabulary(entries)
    index = BlockMaxIndex(entries, terms, np.array([rng.randrange(0, 50) for _ in terms]), 500)
    found, score = index.nearest(queries, 5)
    dense = []
    for texts in (entries, queries):
        row, term, count, other = known_terms(texts, terms)
        m = np.zeros((len(texts), len(terms)))
        m[row, term] = (1 + np.log(count)) * index.idf[term]
        dense.append(m / np.sqrt((m * m).sum(1) + np.bincount(other, minlength=len(texts)) * index.unseen**2)[:, None])
    exact = dense[1] @ dense[0].T
    for i in range(len(queries)):
        want = np.sort(exact[i])[::-1][:5]
        want = want[want >= max(want[0] * SHARE, 1e-9)]
        got = score[i][found[i] >= 0]
        assert len(got) == len(want) and np.allclose(got, want, atol=1e-5)


def test_isotonic_is_the_best_monotone_fit():
    x, y = isotonic(np.array([0.1, 0.2, 0.2, 0.5, 0.9]), np.array([0, 1, 0, 1, 1]))
    assert list(np.interp([0.1, 0.2, 0.9], x, y)) == [0.0, 0.5, 1.0]


BAD = ["you are a complete {} and everyone here knows it", "watch your back tonight, {}", "shut your mouth, {}, nobody asked"]
GOOD = ["the {} camera went silent for two seconds", "we moved the {} tray after lunch", "kill the stuck {} process and restart", "please keep episode {} for training"]


def corpus(seed, n):
    rng = random.Random(seed)
    docs, truth = [], {}
    for i in range(n):
        lines = [rng.choice(GOOD).format(rng.choice(["waist", "blue", "chest", "left"])) for _ in range(rng.randrange(1, 6))]
        truth[i] = rng.random() < 0.3
        if truth[i]:
            s = rng.choice(BAD).format(rng.choice(["moron", "loser", "idiot", "clown"]))
            lines.insert(rng.randrange(len(lines) + 1), rng.choice([s, s.upper(), s.replace("o", "0"), s.replace("i", "ii")]))
        docs.append((i, ". ".join(lines) + ".", f"s{i % 2}"))
    return docs, truth


def test_held_out_documents(spark, crowded):
    docs, truth = corpus(1, 700)
    docs += [(900, None, "s0"), (901, "", None), (902, "12345", "s1"), (903, "fine text. " * 20_000 + "watch your back tonight, moron.", "s1")]
    rng = random.Random(2)
    said = lambda y: rng.choice(["yes", "Y", "1"] if y else ["no", " N", "0"])
    labels = [(i, "r", said(truth[i] != (rng.random() < 0.03))) for i in range(350)] + [(1, "r", "perhaps"), (None, "r", "yes"), (99999, "r", "yes")]
    documents = crowded(spark.createDataFrame(docs, "doc_id long, text string, source string"))
    model = fit_examples(documents, spark.createDataFrame(labels, "doc_id long, reviewer string, offensive string"))
    scored = score_documents(documents, model, keep=["source"])
    got = {r.doc_id: r for r in scored.collect()}
    assert len(got) == len(docs)
    test = range(350, 700)
    right = sum((got[i].probability >= 0.5) == truth[i] for i in test)
    assert right / len(test) > 0.97
    assert got[903].probability >= 0.5 and "watchyourback" in got[903].passage
    assert all(got[i].score == 0 and got[i].passage is None for i in (900, 901, 902))
    rates = {r.source: r for r in offence_rates(scored, "source").collect()}
    assert sum(r.documents for r in rates.values()) == len(docs) and None in rates


def test_labelled_sample_is_bounded(spark):
    docs, truth = corpus(5, 60)
    documents = spark.createDataFrame(docs, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, "yes" if truth[i] else "no") for i in range(60)], "doc_id long, offensive string")
    assert len(set(fit_examples(documents, labels, most_labelled=7).example)) <= 7
    assert len(fit_examples(documents, labels, most_passages=5).index.entries) <= 5


def test_without_labels_or_documents(spark):
    documents = spark.createDataFrame([(1, "any text here")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, offensive string")
    row = score_documents(documents, fit_examples(documents, none)).first()
    assert (row.score, row.probability, row.example) == (0.0, 0.0, None)
    empty = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([(1, "yes")], "doc_id long, offensive string")
    assert score_documents(empty, fit_examples(empty, labels)).collect() == []


@pytest.mark.parametrize("k", [1, 12])
def test_one_entry(k):
    index = BlockMaxIndex(["abcdef"], vocabulary(["abcdef"]), np.array([1, 1, 1]), 3)
    found, score = index.nearest(["abcdef", "zzzzzz", "abcd"], k)
    assert found[0, 0] == 0 and score[0, 0] == pytest.approx(1) and found[1, 0] == -1
