import random

from churnlake.llm.toxicity import CATEGORIES, drop_toxic, features, train


def corpus(spark, n=600):
    rng = random.Random(7)
    words = [a + b + c for a in "bcdfg" for b in ("a", "eu", "i") for c in "lmnrst"]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 6 == 0
        text = rng.choices(words, k=rng.randint(5, 200))
        for _ in range(rng.randint(1, 3) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["Idiot", "scum", "zorkba" + rng.choice(words), "moron", "trash"]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, toxic long"), dict(labels), dict(rows))


def test_held_out_accuracy(spark):
    docs, labels, truth, texts = corpus(spark)
    chain = train(docs, labels.where("doc_id < 400"))
    assert tuple(chain.models) == CATEGORIES and [len(m[2]) for m in chain.models.values()] == [0, 1, 2]
    held = [i for i in truth if i >= 400]
    wrong = [i for i in held if (chain.score(texts[i])[-1] >= 0.5) != truth[i]]
    assert len(wrong) <= 2
    kept = {r["doc_id"] for r in drop_toxic(docs, labels).collect()}
    assert sum((i in kept) == bool(t) for i, t in truth.items()) <= 5


def test_features():
    assert features("Stupid, ÉTÉ x") == {b"stupid", b"4:stup", b"5:stupi", "ÉtÉ".encode(), b"x", b"4:" + "ÉtÉ".encode()[:4]}
    assert features("") == set()


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (7, 1), (None, 1), (99, 1), (4, None), (2, 0)], "doc_id long, toxic long")
    assert drop_toxic(odd_docs, labels).columns == odd_docs.columns
    assert drop_toxic(odd_docs, labels.limit(0)).count() == odd_docs.count()
    assert drop_toxic(odd_docs.limit(0), labels).count() == 0
