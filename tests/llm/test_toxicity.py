import random
import zlib

import pytest

from tests.llm.conftest import clashing
from tillroll.llm import toxicity

RUDE = ["idiot", "scum", "vequxa", "vequba", "vequlo"]


def corpus(n=700):
    rnd = random.Random(14)
    words = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in ("n", "r", "st", "lla")]
    rows, labels = [], []
    for i in range(n):
        text, toxic = rnd.choices(words, k=rnd.randint(5, 120)), int(rnd.random() < 0.3)
        for _ in range(rnd.randint(2, 5) * toxic):
            text.insert(rnd.randrange(len(text)), rnd.choice(["you ", ""]) + rnd.choice(RUDE))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, toxic))
    return rows, labels


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def judged(spark):
    rows, labels = corpus()
    extra = [(9000, None), (9001, ""), (9002, "word " * 200_000 + "idiot"), (9003, "YOU ARE AN 1DIOT!!!"), (9004, "a"), (9004, "a")]
    full = [(i, t, "en", "src0", 0) for i, t in rows + extra]
    docs = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars int")
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return rows, labels, toxicity.judge(clashing(docs), clashing(table)).collect()


def test_held_out_accuracy(judged):
    rows, labels, got = judged
    by_id, toxic = {r.doc_id: r for r in got}, {i: t for i, _, t in labels}
    tested = [i for i, _ in rows if held_out(i)]
    assert all(by_id[i].held_out == held_out(i) for i, _ in rows)
    good, bad = ([by_id[i].score for i in tested if toxic[i] == t] for t in (0, 1))
    assert sum((b > g) + (b == g) / 2 for b in bad for g in good) / (len(bad) * len(good)) > 0.97
    assert sum(by_id[i].predicted == toxic[i] for i in tested) / len(tested) > 0.95


def test_odd_texts_have_scores(judged):
    _, _, got = judged
    odd = [r for r in got if r.doc_id >= 9000]
    assert len(odd) == 6 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert odd[0].score == odd[1].score


def test_features():
    weights = {"idiot": 3.0, "vequ-": 2.0}
    names = toxicity.FEATURES
    row = dict(zip(names, toxicity.features("You, 1diot! VEQUXX is here", toxicity.Lexicon(weights))))
    assert row["hit_density"] == pytest.approx(2 / 5) and row["hit_most"] == 3.0
    assert row["second_person"] == pytest.approx(1 / 5) and row["hit_near_second_person"] == pytest.approx(2 / 5)
    assert row["capital_words"] == 1 / 5 and row["exclamations"] == 1 / 5
    assert toxicity.features(None, toxicity.Lexicon({})) == [0.0] * len(names) == toxicity.features("", toxicity.Lexicon({}))


@pytest.mark.parametrize("labels", [[], [(0, 1, 1)], [(0, 1, None), (None, 1, 1)], [(1, 1, 0), (2, 1, 0)]])
def test_few_labels(spark, docs, labels):
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.judge(docs(["some text", None, "other"]), table).collect()
    assert len(got) == 3 and len({r.score for r in got}) == 1 and 0 <= got[0].score <= 1


def test_few_rows_of_both_classes_and_repeats(spark, docs):
    table = spark.createDataFrame([(i, 1, i % 2) for i in range(12)] * 2, "doc_id long, quality int, toxic int")
    texts = [("idiot " if i % 2 else "fine ") * 4 for i in range(12)]
    got = toxicity.judge(docs(texts), table).collect()
    assert len(got) == 12 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.judge(docs([]), table).count() == 0


def test_labels_held_out_do_not_matter(spark, docs):
    rows, labels = corpus(200)
    flipped = [(i, q, 1 - t if held_out(i) else t) for i, q, t in labels]
    a, b = (spark.createDataFrame(x, "doc_id long, quality int, toxic int") for x in (labels, flipped))
    one, two = ({r.doc_id: r.score for r in toxicity.judge(docs(rows), x).collect()} for x in (a, b))
    assert one == pytest.approx(two)


def test_keep_clean(spark, docs):
    rows, labels = corpus(300)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    frame = clashing(docs(rows))
    kept, scores = toxicity.keep_clean(frame, table), toxicity.judge(frame, table)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in scores.collect() if r.score < 0.5}


def test_keep_clean_sends_each_text_once(spark, docs, monkeypatch):
    rows, labels = corpus(300)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    sent, map_batches = [], toxicity.map_batches
    monkeypatch.setattr(toxicity, "map_batches", lambda df, *more: sent.append(df.schema.simpleString()) or map_batches(df, *more))
    kept = toxicity.keep_clean(clashing(docs(rows)), table)
    assert sent[-1].count("text:string") == 1
    texts = dict(rows)
    assert all(r.text == texts[r.doc_id] for r in kept.collect())
