"""The near-copy stage against the operator's rule by brute force."""

import random

import corpus_pipeline
from touchline.llm import simhash


def test_one_document_of_each_group_stays(spark):
    rng = random.Random(1)
    base = {2 * i: " ".join(f"w{rng.randrange(5000)}" for _ in range(rng.choice((60, 200, 500)))) for i in range(60)}
    rows = dict(base)
    for i, text in base.items():
        words = text.split()
        for at in rng.sample(range(len(words)), rng.randint(0, 3)):
            words[at] = f"edit{rng.randrange(10**9)}"
        rows[i + 1] = " ".join(words)
    rows |= {1000: None, 1001: "", 1002: " \n"}
    prints = {i: simhash.fingerprint((t or "").encode()) & 2**64 - 1 for i, t in rows.items()}
    root = {i: i for i in rows}
    changed = True
    while changed:
        changed = False
        for a in rows:
            for b in rows:
                if (prints[a] ^ prints[b]).bit_count() <= 4 and root[b] < root[a]:
                    root[a], changed = root[b], True
    frame = spark.createDataFrame([*rows.items(), (None, base[0])], "doc_id long, text string")
    kept = [r["doc_id"] for r in corpus_pipeline.single_documents(spark, frame, "").collect()]
    assert sorted(kept, key=str) == sorted([None, *{r for r in root.values()}], key=str)
    assert 1 < len({r for r in root.values()}) < len(rows)
