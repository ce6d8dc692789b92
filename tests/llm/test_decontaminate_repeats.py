"""Decontamination: repeated words cost linear time, and every count is that of brute force."""

import random
import time

from touchline.llm import decontaminate


def brute(doc, items, n=13):
    """(hit words, item ids) of a document, by comparing every window."""
    hit, ids, d = set(), set(), doc.split()
    for i, text in items:
        w = text.split()
        size = min(n, len(w))
        own = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if w else set()
        for b in range(len(d) - size + 1 if w else 0):
            if tuple(d[b:b + size]) in own:
                hit.update(range(b, b + size))
                ids.add(str(i))
    return len(hit), sorted(ids)


def test_random_texts_as_brute_force(spark):
    rng = random.Random(2)
    text = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 7, 8, 9, 12, 13, 14, 20, 40]))) for i in range(40)]
    items += [(100, items[-1][1]), (101, "z " * 30), (102, "a")]
    docs = [(i, text(rng.choice([0, 1, 5, 13, 60]))) for i in range(30)] + [(i, "q " * 9 + rng.choice(items)[1] + " q z z") for i in range(30, 60)]
    docs += [(90, "z " * 50), (91, "z " * 12)]
    found = decontaminate.report(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {r["doc_id"]: (r["n_hit"], list(r["items"])) for r in found.collect()}
    assert got == {i: brute(d, items) for i, d in docs}


def test_one_repeated_word(spark):
    docs = spark.createDataFrame([(1, "la " * 60_000)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "la " * 30_000), (8, "la " * 12 + "lo")], "item_id long, text string")
    begun = time.monotonic()
    row = decontaminate.report(docs, items).first()
    assert (row["n_words"], row["n_hit"], row["items"]) == (60_000, 60_000, ["7"])
    assert time.monotonic() - begun < 60
